"""Ranked search, chat formatting and token alignment against brute force, and on odd input."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from conftest import CLASH, ODD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm import alignment, chat, lexical, tokens
from lakeloom.llm.base import LEAST_LONG

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UP = {i: i + 32 for i in range(65, 91)}


# --- 11 ranked search -----------------------------------------------------------------------------------

def terms(text):
    return TERM.findall((text or "").translate(UP))


def best(docs, item, k=10):
    """(score, doc_id) of the best documents, by the definition."""
    per = [(d, Counter(terms(t))) for d, t in docs]
    per = [(d, c, sum(c.values())) for d, c in per if c]
    rows, total = len(per), sum(n for _, _, n in per)
    df = Counter(t for _, c, _ in per for t in c)
    out = []
    for d, c, n in per:
        m, score = 25 + 75 * n * rows // total, 0
        for t in terms(item):
            if df[t]:
                w = math.floor(1000 * math.log((2 * rows + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
        if score > 0:
            out.append((-score, d if d is not None else LEAST_LONG))
    return [(-s, d) for s, d in sorted(out)[:k]]


def corpus(n=150):
    rng = np.random.default_rng(11)
    vocabulary = [f"t{i}" for i in range(300)]
    p = 1 / np.arange(1, 301)
    out = []
    for i in range(n):
        words = rng.choice(vocabulary, rng.integers(1, 400), p=p / p.sum())
        out.append((i, " ".join(words)))
    out += [(500 + i, out[7][1]) for i in range(40)]  # a group of copies
    out += [(600, "Rare, RARE; rare_word été Été"), (601, None), (602, ""), (603, "--- ***")]
    return out


def results(spark, docs, items, **kw):
    index = lexical.build(spark.createDataFrame(docs, "doc_id bigint, text string"))
    out, folders = lexical.search(index, spark.createDataFrame(items, "item_id bigint, text string"), **kw)
    got = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r.item_id is None, r.item_id or 0, r.rank)):
        got[r.item_id].append((r.score, r.k))
        assert r.rank == len(got[r.item_id]) or sum(i == r.item_id for i, _ in items) > 1
    index.close()
    return dict(got)


def test_search_against_all_scores(spark):
    docs = corpus()
    rng = np.random.default_rng(3)
    items = [(i, " ".join(rng.choice([f"t{i}" for i in range(300)], rng.integers(1, 40)))) for i in range(25)]
    items += [(100, docs[7][1]), (101, "rare rare word"), (102, "été"), (103, "unknown words alone"), (104, None), (105, "")]
    want = {i: w for i, t in items if (w := best(docs, t))}
    assert results(spark, docs, items) == want
    assert {i for i, _ in items} - set(want) == {103, 104, 105}


def test_search_in_blocks_and_by_shuffle(spark, monkeypatch):
    docs, items = corpus(60), [(i, f"t{i} t{i + 1} t{2 * i}") for i in range(12)]
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 9)   # several blocks of items
    monkeypatch.setattr(lexical, "SEND", 0)          # texts are shuffled to the candidates
    monkeypatch.setattr(lexical, "BLOCK_ROWS", 5)
    monkeypatch.setattr(lexical, "PENDING", 500)
    monkeypatch.setattr(lexical, "COUNTED", 50)
    assert results(spark, docs, items) == {i: w for i, t in items if (w := best(docs, t))}


def test_search_odd_rows(spark):
    items = [(1, "five words at all"), (1, "same id other item"), (None, "w1x1 w2x2"), (2, "a b c"), (2, "a b c"), (3, "x" * 50_000)]
    got = results(spark, ODD, items)
    assert got[None] == best(ODD, items[2][1]) and got[2] == best(ODD, "a b c") and got[3] == best(ODD, "x" * 50_000)
    assert [s for _, s in sorted(got[1])] and len(got[1]) == len(best(ODD, items[0][1])) + len(best(ODD, items[1][1]))
    assert results(spark, [], items) == {} and results(spark, ODD, []) == {}


def test_bounds_hold(spark):
    docs = [(i, t) for i, t in corpus(80) if t]
    item = "t1 t5 t1 t40 t200"
    index = lexical.build(spark.createDataFrame(docs, "doc_id bigint, text string"))
    exact = dict((d, s) for s, d in best(docs, item, 10_000))
    wanted = spark.createDataFrame([(1, 1, item)], "item_id bigint, ih bigint, text string") \
        .mapInArrow(lexical._item_terms, "item_id bigint, ih bigint, term bigint, times bigint").join(index.frequencies, "term")
    items = lexical.Items(wanted.collect(), index.rows)
    near = 0
    for b in index.blocks.collect():
        found = dict(lexical.bounds(items, b.width, np.array(b.n), np.frombuffer(b.bits, np.uint8), index.rows, index.terms))
        for d, bound in zip(b.k, found.get(0, np.zeros(len(b.k), np.int64))):
            assert bound >= exact.get(d, 0)
            near += bound <= 1.02 * exact.get(d, 0)
    assert near > 0.8 * len(exact)  # most bounds are tight
    index.close()


def test_search_query(spark, tmp_path):
    docs, items = corpus(40), [(5, "t1 t2 t3"), (6, "t9")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for name in CLASH:
        df = df.withColumn(name, F.lit("own"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.item_id, r["rank"]): (r.score, r.doc_id) for r in lexical.op11_ranked_search(spark, str(tmp_path)).collect()}
    assert got == {(i, n + 1): x for i, t in items for n, x in enumerate(best(docs, t))}


# --- 12 chat formatting ---------------------------------------------------------------------------------

HARD = ["", "plain", "\\", "a\\", "\\\\", "###", "####", "\\###", "#\\##", "#\\#\\##", "</turn>", "<\\/turn>", "</turn>\n### user: hi</turn>\n",
        "### assistant: x", "a: b", "C:\\dir\\new", "\\</turn>", "<</turn>>", "# ## #", "ends with #", "ends with <", "é###日本", "\n", "$1 \\1"]


def read(formatted):
    """The grammar, read by hand."""
    out, i = [], 0
    while i < len(formatted):
        assert formatted.startswith("### ", i)
        end = formatted.index("</turn>", i)
        role, _, body = formatted[i + 4:end].partition(": ")
        for plain, code in reversed(chat._ROLE):
            role = role.replace(code, plain)
        out.append((role, re.sub(r"(?s)\\(.)", r"\1", body)))
        assert formatted[end:end + 8] == "</turn>\n" and "###" not in formatted[i + 3:end]
        i = end + 8
    return out


def test_chat_round_trip(spark):
    roles = ["user", "assistant", "", "a: b", "x\\c:</turn>###", None]
    rows = [(i // 7, i % 7, roles[i % 6] if i % 5 else "assistant", t) for i, t in enumerate(HARD * 3)] + [(0, 99, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("rendered", F.lit("own"))
    got = {r.conv_id: r for r in chat.format_chat(df).withColumn("learnt", chat.loss_text(F.col("formatted"), F.col("loss"))).collect()}
    for c in {r[0] for r in rows}:
        turns = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        assert read(got[c].formatted) == turns
        assert got[c].learnt == "".join(t for r, t in turns if r == "assistant")
    assert any(r.n_escaped for r in got.values())


def test_chat_escapes_only_conflicts(spark):
    df = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(HARD)], "conv_id bigint, turn bigint, role string, text string")
    level = {r.text: r.level for r in chat.render_turns(df).collect()}
    for t in HARD:
        assert level[t] == (2 if re.search(r"(?s)\\.", t) else 1 if "###" in t or "</turn>" in t else 0), t


def test_chat_odd_rows(spark, tmp_path):
    schema = "conv_id bigint, turn bigint, role string, text string, level string"
    rows = [(None, None, None, None, "x"), (None, 1, "user", "b", "x"), (1, 2, "user", "same", "x"), (1, 2, "user", "same", "x"),
            (1, None, "assistant", "last", "x"), (2, 0, "assistant", "y\\###" * 60_000, "x")]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op12_chat_format(spark, str(tmp_path)).collect()}

    def digest(turns):
        return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()

    assert got[None].turns_sha256 == digest([("user", "b"), ("", "")]) and got[None].loss_chars == 0
    assert got[1].turns_sha256 == digest([("user", "same"), ("user", "same"), ("assistant", "last")]) and got[1].n_turns == 3
    assert got[2].loss_sha256 == hashlib.sha256(rows[-1][3].encode()).hexdigest() and got[2].loss_chars == 300_000
    assert got[-7].turns_sha256 == digest([(r, "\\### Assistant: </turn> ok") for r in ("user", "assistant")])
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert [r.conv_id for r in chat.op12_chat_format(spark, f"{tmp_path}/none").collect()] == [-7]


# --- 13 token alignment ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def both():
    library = Tokenizer.from_file(tokens.tokenizer_path(alignment.BYTE_BPE))
    library.encode_special_tokens = True
    back = tokens.byte_letters()
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_path(alignment.PIECES))

    def cut(text):
        """((id, begin, end) of A, of B) or None."""
        if not text:
            return None
        a = library.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(back[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
        right = [(i, bytes([i - 3]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
        out = []
        for side in (left, right):
            if b"".join(x for _, x in side) != (" " + text).encode():
                return None
            at, rows = 0, []
            for i, x in side:
                rows.append((i, at, at + len(x)))
                at += len(x)
            out.append(rows)
        return out

    return cut


TEXTS = ["Hello world, this is a test.", "été à l'école\n\n  two  blanks", "日本語のテキスト and emoji 😀", "<|endoftext|> </s> <unk> <0x41>", "x" * 3000,
         "1234567 89 3.14159", "tab\tand\r\nline", " leading and trailing ", "a", "", None, "▁ real block", "Ein längerer Satz mit Wörtern, die zerlegt werden.",
         "null\0byte", "ﬁ ligature ½ ①"]


def expected(cut, rows):
    count, per = Counter(), []
    for d, t in rows:
        got = cut(t)
        if got is None:
            per.append((d, None))
            continue
        a, b = got
        ends = {e: i for i, _, e in b}
        pairs = [(i, ends[e]) for i, _, e in a if e in ends]
        count.update(pairs)
        text, left, right, at = [], [], [], sorted({e for _, _, e in a} & {e for _, _, e in b})
        for e in at:
            lo = at[at.index(e) - 1] if at.index(e) else 0
            left = [str(i) for i, _, x in a if lo < x <= e]
            right = [str(i) for i, _, x in b if lo < x <= e]
            text.append(",".join(left) + "|" + ",".join(right))
        per.append((d, (len(a), len(b), len(at), pairs, hashlib.sha256(";".join(text).encode()).hexdigest())))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for d, x in per:
        if x is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, pairs, sha = x
            out.append((d, n_a, n_b, groups, len(pairs), sum(count[p] == most[p[1]] for p in pairs), sum(count[p] for p in pairs), sha))
    return sorted(out, key=repr), count


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment(spark, docs, tmp_path, both, monkeypatch):
    rows = [(3 * i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (7, "same id"), (7, "same id"), (8, TEXTS[0])] + \
        [(100 + i, f"document {i} with words {i * i} and été {i}") for i in range(60)]
    want, count = expected(both, rows)
    docs(rows, CLASH).write.parquet(f"{tmp_path}/documents.parquet")
    got = alignment.op13_token_alignment(spark, str(tmp_path)).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == want
    monkeypatch.setattr(alignment, "CHUNK_TEXT", 300)
    monkeypatch.setattr(alignment, "PART_TEXT", 100)
    out, pairs, _ = alignment.align(docs(rows))
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=repr) == want
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(count)


def test_alignment_holds_a_chunk_at_a_time(spark, docs, tmp_path, both, monkeypatch):
    """A task with many chunks writes and reads them in row groups of bounded bytes, and answers one at a time."""
    import pyarrow.parquet as pq
    rows = [(i, " ".join(f"word{i * j % 997}" for j in range(150))) for i in range(60)]
    monkeypatch.setattr(alignment, "CHUNK_TEXT", 1000)
    monkeypatch.setattr(alignment, "CUT_BLOCK", 4000, raising=False)
    out, _, folders = alignment.align(docs(rows).coalesce(1))
    files = [pq.ParquetFile(f) for f in sorted(Path(folders[0].removeprefix("file:")).glob("*.parquet"))]
    groups = [f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(groups) >= 30 and max(groups) <= 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=repr) == expected(both, rows)[0]


def test_alignment_empty(spark, docs):
    out, pairs, _ = alignment.align(docs([]))
    assert out.collect() == [] and pairs.collect() == []


@pytest.mark.parametrize("kind", ["overlap", "end", "group"])
def test_links_against_dense(both, kind):
    pair = alignment.pair(*(tokens.tokenizer_path(f) for f in (alignment.BYTE_BPE, alignment.RANKS, alignment.PIECES)))
    texts = [t for t in TEXTS if t]
    a, b, whole = pair.cuts(texts)
    assert [bool(x) for x in whole] == [both(t) is not None for t in texts]
    want, base, ia, ib = set(), 0, 0, 0
    for t in texts:
        got = both(t)
        if got is None:
            continue
        left, right = got
        ends = sorted({e for _, _, e in left} & {e for _, _, e in right})
        group = lambda e: next(i for i, x in enumerate(ends) if e <= x)  # noqa: E731, B023
        if len(left) * len(right) < 200_000:
            for i, (_, a0, a1) in enumerate(left):
                for j, (_, b0, b1) in enumerate(right):
                    shared = min(a1, b1) - max(a0, b0)
                    n = {"overlap": max(shared, 0), "end": int(a1 == b1), "group": int(group(a1) == group(b1))}[kind]
                    if n:
                        want.add((ia + i, ib + j, n))
        ia, ib = ia + len(left), ib + len(right)
    big = max(range(len(texts)), key=lambda i: len(texts[i]))
    got = {(int(x), int(y), int(v)) for part in alignment.links(a, b, kind) for x, y, v in zip(*part)}
    small = [i for i, t in enumerate([t for t in texts if both(t)]) if len(both(t)[0]) * len(both(t)[1]) < 200_000]
    keep = set(np.concatenate([np.arange(a.first[i], a.first[i + 1]) for i in small]).tolist())
    assert {x for x in got if x[0] in keep} == want and big >= 0


def test_product_by_blocks():
    rng = np.random.default_rng(0)
    left, right = rng.integers(0, 3, (20, 30)) * (rng.random((20, 30)) < 0.2), rng.integers(1, 4, (30, 15)) * (rng.random((30, 15)) < 0.3)

    def csr(m):
        r, c = np.nonzero(m)
        return alignment.Csr(np.searchsorted(r, np.arange(m.shape[0] + 1)), c, m.shape[1], m[r, c])

    for work in (1, 7, 1 << 20):
        dense = np.zeros((20, 15), np.int64)
        for r, c, v in alignment.products(csr(left), csr(right), work):
            dense[r, c] += v
        assert (dense == left @ right).all()
    back = csr(left).transposed().transposed()
    assert (back.indices == csr(left).indices).all() and (back.values == csr(left).values).all()


# --- 3 near duplicates: recall --------------------------------------------------------------------------

def test_near_duplicate_recall(spark, docs):
    """Links of every document whose id is divisible by 50, against brute force; families without their original included."""
    from lakeloom.llm import neardup
    rng = np.random.default_rng(8)
    out, number = [], 0

    def add(words):
        nonlocal number
        out.append((number, " ".join(words)))
        number += 1

    def changed(words, places):
        words = list(words)
        for i in rng.choice(len(words), places, replace=False):
            words[i] = f"n{rng.integers(1 << 30)}"
        return words

    for _ in range(30):  # pairs and small groups
        base = [f"v{i}" for i in rng.integers(0, 5000, 150)]
        add(base)
        for places in (1, 2, 3):
            add(changed(base, places))
    for kept in (True, False):  # large families: alike to the original, less so to each other
        base = [f"v{i}" for i in rng.integers(0, 5000, 300)]
        if kept:
            add(base)
        for _ in range(150):
            add(changed(base, int(rng.integers(2, 6))))
    sets = {}
    for i, t in out:
        w = t.split()
        sets[i] = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4))
    got = {r.doc_id: r.class_id for r in neardup.near_classes(docs(out)).collect()}
    links = found = 0
    for a in range(0, number, 50):
        for b in range(number):
            if a != b:
                inside = sum((sets[a] & sets[b]).values())
                if inside >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - inside):
                    links, found = links + 1, found + (got[a] == got[b])
    assert links > 50 and found >= 0.9 * links, (links, found)


def test_near_duplicates_apart_from_the_hub(spark, docs):
    """In a bucket of unlike texts those that are not like the hub are compared with each other."""
    from lakeloom.llm import neardup
    rng = np.random.default_rng(4)
    base = [f"v{i}" for i in range(400)]

    def changed(words, places):
        words = list(words)
        for i in places:
            words[i] = f"n{rng.integers(1 << 30)}"
        return words

    out = []
    for _ in range(40):  # parents of similarity 0.6 or so share buckets; each has one close copy
        parent = changed(base, rng.choice(400, 10, replace=False))
        out += [(len(out), " ".join(parent)), (len(out) + 1, " ".join(changed(parent, rng.choice(400, 7, replace=False))))]
    sets = [Counter(tuple(t.split()[j:j + 5]) for j in range(396)) for _, t in out]
    got = {r.doc_id: r.class_id for r in neardup.near_classes(docs(out)).collect()}
    links = [(a, b) for a in range(80) for b in range(a) if 18 * sum((sets[a] & sets[b]).values()) >= 8 * 792]
    assert len(links) >= 20 and sum(got[a] == got[b] for a, b in links) >= 0.97 * len(links)


def test_near_duplicates_of_large_mixed_buckets(spark, docs, monkeypatch):
    """All texts of a bucket are compared unless they are in one class already, however many are unlike its hub."""
    from lakeloom.llm import arrays, neardup
    rng = np.random.default_rng(5)
    base = [f"v{i}" for i in range(200)]

    def changed(words, times):
        words = list(words)
        for i in rng.choice(200, times, replace=False):
            words[i] = f"n{rng.integers(1 << 30)}"
        return words

    out = []
    for _ in range(250):  # parents of similarity 0.65 or so fill buckets; each has one copy of similarity 0.8 or a little more
        parent = changed(base, 4)
        out += [(len(out), " ".join(parent)), (len(out) + 1, " ".join(changed(parent, 4)))]
    strings = next(arrays.slices(pa.array([t for _, t in out])))[1]
    keys, owner, times = neardup.multisets(*neardup.shingles(arrays.words_of(strings)[1]))
    slots = neardup.signatures(keys, owner, times, len(out)).reshape(len(out), neardup.BANDS, neardup.ROWS)
    sets = [set(keys[owner == i].tolist()) for i in range(len(out))]  # no shingle comes twice
    links = [(a, b) for a in range(len(out)) for b in np.flatnonzero((slots[:a] == slots[a]).all(axis=2).any(axis=1)).tolist()
             if 18 * len(sets[a] & sets[b]) >= 8 * (len(sets[a]) + len(sets[b]))]
    label = list(range(len(out)))
    for a, b in links:
        label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
    assert len(links) >= 150 and len(set(label)) > 50
    for block in (None, 16):
        if block:
            monkeypatch.setattr(neardup, "BLOCK", block, raising=False)
        got = {r.doc_id: r.class_id for r in neardup.near_classes(docs(out)).collect()}
        assert [got[i] for i in range(len(out))] == label


# --- 8 packing: checksums in place of ids ---------------------------------------------------------------

def test_packing_digests(docs):
    import zlib

    from lakeloom.llm import packing
    rows = [(i, " ".join(f"word{j * i}" for j in range(i * 7 % 90))) for i in range(40)] + [(None, None), (7, "same"), (7, "same")]
    library = Tokenizer.from_file(tokens.tokenizer_path())
    ids = sorted((repr(d), [*library.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in rows)
    got = packing.pack_digests(docs(rows), capacity=64).collect()
    want = []
    for d, x in ids:
        begin = [0, *range(len(x) % 64 or 64, len(x), 64)] if len(x) > 64 else [0]
        want += [(d, k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(begin, [*begin[1:], len(x)]))]
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:i]) for i in range(len(x))] and sum(n for _, n in x) <= 64

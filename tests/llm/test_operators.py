"""Operators against brute force, and on odd input: nulls, empty, long and repeated rows, clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import CLASH, ODD
from pyspark.sql import functions as F

from lakeloom.llm import (arrays, fingerprints, language_model, mixing, neardup, packing, quality, rans, sharding, substrings,
                          token_counts, token_files, tokens)
from lakeloom.session import shared_dir

WORD = re.compile("[^\x20\x09-\x0D]+")


def small(n=60):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(40)]
    out = [(3 * i, " ".join(rng.choice(vocabulary, rng.integers(1, 60)))) for i in range(n)]
    base = " ".join(rng.choice([f"v{i}" for i in range(300)], 120)).split()
    for i in range(8):  # near copies and shared passages
        copy = list(base)
        copy[5 * i] = "changed"
        out.append((1000 + i, " ".join(copy)))
        out.append((2000 + i, out[i][1] + " " + " ".join(base[20:50])))
    return out


# --- shared array helpers -------------------------------------------------------------------------------

def test_words_and_windows():
    texts = ["a  bc\n\td", "", " ", "é x", "one"]
    _, runs = arrays.words_of(pa.array(texts, pa.large_string()))
    assert runs.per_text().tolist() == [len(WORD.findall(t)) for t in texts]
    h = runs.hashes()
    assert len(set(h.tolist())) == 6
    assert arrays.window_starts(runs.first, 2).tolist() == [0, 1, 3]
    _, again = arrays.words_of(pa.array(["zz a", "bc d"], pa.large_string()))
    assert again.hashes()[1] == h[0]  # a word's hash does not depend on its place
    _, up = arrays.words_of(pa.array(["ABC É", "abc É"], pa.large_string()))
    low = up.hashes(lower=True)
    assert low[0] == low[2] and low[1] == low[3]


# --- 1 fingerprints -------------------------------------------------------------------------------------

def shingles(text, n=5):
    w = WORD.findall(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_fingerprints(spark, docs, tmp_path):
    rows = small()
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in fingerprints.op1_fingerprints(spark, str(tmp_path)).collect()}
    rows.sort()
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + after[:cut]
        r = got[d]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(t)
        a, b = shingles(t), shingles(edited)
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b))  # small texts keep all shingles
    assert len({r.fingerprint for r in got.values()}) == len({frozenset(shingles(t)) for _, t in rows})


def test_fingerprint_scaled(spark):
    df = spark.createDataFrame([(" ".join(f"a{i}" for i in range(4000)),)], "text string")
    df = fingerprints.with_sketch(df, "text", "s")
    df = fingerprints.with_sketch(df.withColumn("part", F.substring("text", 1, 3000)), "part", "p")
    r = fingerprints.overlap(df, "p", "s", "x").first()
    assert 350 < len(r.s) < 650 and not r.s_full and r.inside_x > 0.97


def test_short_text_inside_and_outside_a_long_one(spark, docs, tmp_path):
    rows, want = [], {}
    for i in range(60):
        long = [f"l{i}w{j}" for j in range(700)]
        short = [f"s{i}w{j}" for j in range(14)] if i % 3 == 0 else long[5 * i:5 * i + 14]
        if i % 3 == 1:
            short = short[:9] + [f"s{i}w{j}" for j in range(5)]  # five of ten shingles
        rows += [(2 * i, " ".join(short)), (2 * i + 1, " ".join(long))]
        want[2 * i] = (0.0, 0.5, 1.0)[i % 3]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.inside_next for r in fingerprints.op1_fingerprints(spark, str(tmp_path)).collect()}
    assert {d: got[d] for d in want} == want
    pairs = spark.createDataFrame([(a[1], b[1]) for a, b in zip(rows[::6], rows[1::6])], "a string, b string")
    pairs = fingerprints.with_sketch(fingerprints.with_sketch(pairs, "a", "x"), "b", "y")
    assert {r.inside_p for r in fingerprints.overlap(pairs, "x", "y", "p").collect()} == {0.0, None}  # sketches alone cannot tell


# --- 2 sharding -----------------------------------------------------------------------------------------

def test_sharding(spark, docs):
    rows = [(i, f"text {i % 300} " * (1 + i % 7)) for i in range(3000)] + [(5000 + i, "copy " * 30) for i in range(1500)]
    got = sharding.shard(docs(rows), shards=8).select("row.doc_id", "row.text", "size", "shard", "slot").collect()
    assert len(got) == len(rows)
    weight = Counter()
    for r in got:
        assert r["size"] == len(r.text.encode()) + 16
        weight[r.shard] += r["size"]
    even = sum(weight.values()) / 8
    assert set(weight) == set(range(8)) and max(abs(v - even) for v in weight.values()) < 0.03 * even
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_sharding_cuts_between_repeated_rows(spark, docs, tmp_path):
    rows = [(None, "the very same words again and again")] * 3000 + [(i, f"own text {i} " * 3) for i in range(1000)]
    docs(rows).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    for df in (docs(rows), spark.read.parquet(f"{tmp_path}/documents.parquet")):  # rows of a session, rows of files
        got = sharding.shard(df).select("row.doc_id", "row.text", "size", "shard", "slot").collect()
        assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
        weight = Counter()
        for r in got:
            weight[r.shard] += r["size"]
        even = sum(weight.values()) / 40
        assert set(weight) == set(range(40)) and max(abs(v - even) for v in weight.values()) < 0.03 * even
        for s in range(40):
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


# --- 4 quality ------------------------------------------------------------------------------------------

def test_quality_counts_and_verdict(spark, docs):
    good = [(i, f"plain clean words about topic number{i % 9} and the rest of a sentence that goes on number{i % 7} for some more words") for i in range(80)]
    bad = [(1000 + i, " ".join(f"junk!!{(i * j) % 50}###" for j in range(30))) for i in range(30)]
    odd = [(2000, "a b c d e f g h a b c d e f g h x"), (2001, "same line\n\nsame line\n \nother"), (2002, "#*$%&|<> é")]
    df = docs(good + bad + odd)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:40]] + [(1000, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.scored(df, quality.log_ratios(df, labels, prior=0.01)).select("row.doc_id", "*").collect()}
    for d, t in good + bad + odd:
        w = WORD.findall(t)
        seen = Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
        cover = {k for j in range(len(w) - 7) if seen[tuple(w[j:j + 8])] > 1 for k in range(j, j + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
    assert all(got[d].kept for d, _ in good) and not any(got[d].kept for d, _ in bad)


@pytest.mark.parametrize("n", [60, 300, 1500])
def test_quality_verdict_does_not_depend_on_size(spark, n):
    rng = np.random.default_rng(n)

    def prose(kind):
        other = rng.random(60) < (0.35 if kind == "junk" else 0.03)
        return " ".join(f"{'junk' if o else 'word'}{i}" for o, i in zip(other, rng.zipf(1.4, 60) % 400))

    rows = [(i, prose("junk" if i % 4 == 0 else "good")) for i in range(2 * n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(n)], "doc_id bigint, quality int, toxic int")
    got = quality.scored(df, quality.log_ratios(df, labels)).where("not base_failed").select("row.doc_id", "kept").collect()
    good, bad = ([r.kept for r in got if (r.doc_id % 4 == 0) == junk and r.doc_id >= n] for junk in (False, True))
    assert np.mean(good) > 0.93 and np.mean(bad) < 0.1


def test_toxic_texts_are_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 1, None), (4, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert sorted(r.doc_id for r in quality.trusted_ids(labels).collect()) == [1, 3]


def test_all_trusted_texts_are_used(spark, monkeypatch):
    labels = spark.range(200_010).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert quality.trusted_ids(labels).count() == 200_010
    rows = [(i if i % 9 else None, f"own{i} " + " ".join(f"v{(i * j) % 91}" for j in range(40))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sent = quality.log_ratios(df, labels.where("doc_id < 90"))
    monkeypatch.setattr(quality, "MOST_SENT", 10, raising=False)
    assert sent.any() and (quality.log_ratios(df, labels.where("doc_id < 90")) == sent).all()


def test_too_few_trusted_texts_judge_nothing(spark):
    df = spark.createDataFrame([(i, f"own{i} " + " ".join(f"v{(i * j) % 91}" for j in range(40))) for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert not quality.log_ratios(df, labels).any()


# --- 5, 6 tokens ----------------------------------------------------------------------------------------

PARTS = ["a", "the", " ", "  ", "\n", "\t", "'s", "don't", ".", ",", "é", "1", "23", "<|endoftext|>", " ", "日本", "!!", "\r\n",
         "x.", "ß", "\x1c", " .", "Σ", "İ"]


def odd_texts(n, seed=3):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(PARTS, rng.integers(0, 9))) for _ in range(n)]


def test_encoder_is_the_library():
    e = tokens.Encoder(tokens.tokenizer_path())
    texts = odd_texts(3000) + [t or "" for _, t in ODD]
    want = [x.ids for x in e.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == want
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == want  # from the memo


class Calls:
    """Notes the calls of methods of ``of`` and of its model."""

    def __init__(self, of, calls):
        self.of, self.calls = of, calls

    def __getattr__(self, name):
        got = getattr(self.of, name)
        if not callable(got):
            return Calls(got, self.calls)

        def called(*args, **more):
            self.calls.append(name)
            return got(*args, **more)

        return called


def test_encoder_calls_the_library_for_many_words_at_once():
    parts = ["th", "an", "er", "ti", "È", "ción", "ou", "bl", "nd"]
    words = [a + b + c + d for a in parts for b in parts for c in parts for d in parts[:6]]
    e, calls = tokens.Encoder(tokens.tokenizer_path()), []
    texts = [" ".join(words[i::4]) + " 12 it's\nEnd" for i in range(4)]
    again = [", ".join(words[i::5]) + ". " + " ".join(words[:9]) for i in range(5)]
    want = [[np.array(x.ids, "<u4").tobytes() for x in e.library.encode_batch(t, add_special_tokens=False)] for t in (texts, again)]
    for name in {"library", "merges"} & vars(e).keys():
        setattr(e, name, Calls(getattr(e, name), calls))
    assert e.encode(texts) == want[0] and len(calls) < len(words) / 50
    calls.clear()
    assert e.encode(again) == want[1] and len(calls) < 10  # words are remembered without their marks


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    e, most = tokens.Encoder(tokens.tokenizer_path()), 0
    for k in range(40):
        once = ["abcdefghij"[k % 10] + "x" * (1 + k // 10) + "klmnopqrst"[j % 10] + "y" * (j // 10) for j in range(30)]
        texts = ["an often always. " + " ".join(once), "It's often, " + "z" * (70 + k), "always"]
        assert e.encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in e.library.encode_batch(texts, add_special_tokens=False)]
        known = e.memo.pieces.to_pylist()
        most = max(most, len(known))
        assert len(known) <= 100 and len(set(known)) == len(known) and max(map(len, known)) <= tokens.LONGEST_MEMO
        assert {"often", "always"} <= set(known)
    assert most > 50


def test_token_counts_are_the_library(docs):
    texts = odd_texts(2000, 4) + [t for _, t in ODD]
    got = token_counts.count_tokens(docs(list(enumerate(texts)))).collect()
    library = token_counts.Tokenizer.from_file(tokens.tokenizer_path(token_counts.VOCABULARY))
    for r in got:
        t = texts[r.doc_id] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 2048)


def test_range_coder():
    rng = np.random.default_rng(1)
    blocks = [(rng.zipf(1.3, n) % 50_000).astype("<u4") for n in (0, 1, 127, 128, 129, 32_768, 32_769, 100_000)]
    t = rans.table(np.bincount(np.concatenate(blocks)))
    coded = rans.encode(blocks, t)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, rans.decode(coded, t)))
    broken = bytearray(coded[-1])
    broken[-5] ^= 1
    with pytest.raises(ValueError):
        rans.decode([bytes(broken)], t)


def test_token_files(spark, docs):
    rows = [(d, t) for d, t in ODD if d is not None] + small(20)
    path = shared_dir(spark, "test-tokens")
    token_files.write_tokens(docs(rows), path)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    e = tokens.Encoder(tokens.tokenizer_path())
    assert [r.doc_id for r in got] == sorted(d for d, _ in rows)
    want = Counter((d, e.encode([t or ""])[0] + bytes(4)) for d, t in rows)
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens


# --- 8 packing ------------------------------------------------------------------------------------------

def test_place_is_the_rule():
    rng = np.random.default_rng(2)
    sizes = np.sort(rng.integers(1, 33, 400))[::-1]
    sequence, offset = packing.place(sizes, 32)
    gaps, count = [], Counter()
    for s, q, o in zip(sizes.tolist(), sequence.tolist(), offset.tolist()):
        fits = {g for g in gaps if g >= s}
        if fits:
            def after(g):
                c = count.copy()
                c[g] -= 1
                if g > s:
                    c[g - s] += 1
                return sum(v * v for v in c.values())
            best = min(after(g) for g in fits)
            assert after(32 - o) == best and q < len(gaps)
            gaps[q] -= s
            count[32 - o] -= 1
        else:
            assert q == len(gaps) and o == 0
            gaps.append(32 - s)
        assert gaps[q] == 32 - o - s
        if gaps[q]:
            count[gaps[q]] += 1


def test_pack(docs):
    got = packing.pack(docs(ODD + small(30)), capacity=256).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        assert 1 <= r.length <= 256 and len(r.ids) == 4 * r.length
        by_doc.setdefault((r.doc_id, r.piece), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 256
    assert len(by_doc[(7, 0)]) == 1 and all(r[0].length == 256 for (d, p), r in by_doc.items() if d == 7 and p)
    assert packing.cut(bytes(4 * 512), 256)[1][0] == 256


def test_rows_without_an_own_id_do_not_gather(docs):
    rows = [(None, f"text number {i} of many") for i in range(300)] + [(7, f"other text {i} of many") for i in range(300)] \
        + [(8, "the same row again")] * 300
    got = packing.pack(docs(rows), capacity=256, group_bytes=2000).collect()
    groups = Counter(r.sequence_id >> 40 for r in got)
    assert len(got) == 900 and len(groups) > 5 and max(groups.values()) < 2.5 * 900 / len(groups)


# --- 7 language model -----------------------------------------------------------------------------------

def test_language_model(docs):
    rows = [(i, t) for i, (_, t) in enumerate(small(200) + [(0, None), (0, "UPPER lower upper")])]
    df, chunks = language_model.score(docs(rows), chunk_bytes=2000)
    got = {r.doc_id: r for r in df.collect()}
    chunks.close()
    words = {d: [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORD.findall(t or "")] + [None] for d, t in rows}
    fold = {d: zlib.crc32(str(d).encode()) % 10 for d in words}
    c, pair, context = Counter(), Counter(), Counter()
    for d, w in words.items():
        if fold[d]:
            c.update(w)
            pair.update(zip([0, *w], w))
            context.update([0, *w[:-1]])
    n, v = sum(c.values()), len(c)
    for d, w in words.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[d] == 0, len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    # the mixture over a whole context sums to one: every known word and one unknown
    a = np.array([0.5, 0.3, 0.2])
    total = sum(a[0] * pair[(0, x)] / context[0] + a[1] * c[x] / n + a[2] / (v + 1) for x in c) + a[2] / (v + 1)
    assert total == pytest.approx(1)


def test_weights_favour_the_better_estimate():
    w = language_model.learn_weights([(3, 20, 10, 100), (3, 0, 10, 5), (5, 5, 20, 100)])
    assert w[3][0] > 0.7 and w[5][1] > 0.7 and np.allclose(w.sum(axis=1), 1)


# --- 3 near duplicates ----------------------------------------------------------------------------------

def bag(text, n=5):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def brute_classes(rows):
    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, either = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
            if 10 * both >= 8 * either:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    names = {}
    for i in range(len(rows)):
        names.setdefault(find(i), []).append(rows[i][0])
    return sorted(sorted(v) for v in names.values())


def test_near_classes(docs):
    base = [f"b{i}" for i in range(200)]
    rows = small(40)
    for i in range(30):  # a chain: neighbours alike, ends not
        rows.append((5000 + i, " ".join(base[2 * i:2 * i + 100])))
    rows += [(6000, "the same words twice " * 12), (6001, "the same words twice " * 13), (6002, "the same words twice " * 30)]
    got = {}
    for r in neardup.near_classes(docs(rows)).collect():
        got.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(sorted(v) for v in got.values()) == brute_classes(rows)
    assert all(min(v) == k for k, v in got.items())


def test_signature_is_unbiased():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    a[:10], b[50:] = 0, 0
    owner = np.repeat([0, 1], 60)
    times = np.concatenate([a, b])
    some = times > 0
    ids = neardup.signatures(np.concatenate([keys, keys])[some], owner[some], times[some], 2, slots=8192)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((ids[0] == ids[1]).mean() - want) < 4 * math.sqrt(want * (1 - want) / 8192)


# --- 10 substrings --------------------------------------------------------------------------------------

def brute_substrings(rows, length=20):
    seen, out = set(), {}
    for d, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            if key in seen:
                gone.update(range(i, i + length))
            seen.add(key)
        out[d] = (len(w), len(gone), [x for i, x in enumerate(w) if i not in gone])
    return out


@pytest.mark.parametrize("chunk_bytes", [700, 1 << 20])
def test_substrings(docs, chunk_bytes):
    rows = small(40) + [(9000, "p q r s t u v w x y " * 6), (9001, None)]
    df, chunks = substrings.dedup(docs(rows), chunk_bytes=chunk_bytes)
    got, want = {r.row.doc_id: r for r in df.collect()}, brute_substrings(rows)
    chunks.close()
    for d, t in rows:
        r = got[d]
        assert (r.n_words, r.n_removed, WORD.findall(r.row.text or "")) == want[d]
        assert r.n_removed or r.row.text == t
        assert all(f.length >= 20 for f in r.factors)


def test_factors_are_phrases_of_their_block(docs):
    x = [f"x{i}" for i in range(60)]
    rows = [(1, " ".join(x[:30])), (2, " ".join(x[10:60])), (3, " ".join(x)), (4, " ".join(x[5:58]))]
    for chunk_bytes in (1 << 20, 300):
        df, chunks = substrings.dedup(docs(rows), chunk_bytes=chunk_bytes)
        got = {r.doc_id: r for r in df.select("row.doc_id", "factors").collect()}
        stored = {r.slice: r.body for r in chunks.spark.table(chunks.table).collect()}
        words = {k: " ".join(t or "" for t in pa.ipc.open_stream(bytes(b)).read_all()
                             .column("text").to_pylist()).split() for k, b in stored.items()}
        chunks.close()
        for d, t in rows:
            for f in got[d].factors:
                assert words[f.block][f.position:f.position + f.length] == t.split()[f.start:f.start + f.length]
        assert [(f.start, f.length) for f in got[3].factors] == [(0, 30), (11, 49)]


def test_more_chunks_than_buckets(spark, docs):
    rows, limit = small(40), "spark.sql.sources.bucketing.maxBuckets"
    spark.conf.set(limit, "3")
    try:
        df, chunks = substrings.dedup(docs(rows), chunk_bytes=700)
        got, want = {r.row.doc_id: r for r in df.collect()}, brute_substrings(rows)
        assert chunks.count > 3 == chunks.buckets
        assert all((got[d].n_words, got[d].n_removed) == want[d][:2] for d, _ in rows)
        chunks.close()
    finally:
        spark.conf.unset(limit)


# --- 9 mixing -------------------------------------------------------------------------------------------

def test_mixing_meets_targets(docs):
    rows = [(i, "word " * (20 + i % 60)) for i in range(900)]
    df = mixing.mix(docs(rows), sources={"s0": 0.3, "s1": 0.7}, languages={"en": 0.5, "": 0.5}, topics=1.0, rounds=30)
    got = df.groupBy("source", "lang").agg(F.sum(F.col("tokens") * F.col("probability")).alias("t")).collect()
    whole = sum(r.t for r in got)
    assert sum(r.t for r in got if r.source == "s1") / whole == pytest.approx(0.7, abs=1e-3)
    assert sum(r.t for r in got if r.lang == "en") / whole == pytest.approx(0.5, abs=1e-3)
    assert df.agg(F.max("probability")).first()[0] == pytest.approx(1)


@pytest.mark.parametrize("rare", [[("it", "word " * 240)], [(None, "word " * 240)], [("en", "ab")],
                                  [("it", "ab"), (None, "ab"), ("en", "ab"), ("es", "word " * 2000)]])
def test_rare_values_do_not_set_the_rate(spark, rare):
    langs = ["en"] * 6 + ["de", "de", "fr", "es"]
    rows = [(i, "word " * (100 + i % 900 if i % 2 else 1300), langs[i % 10], f"s{i % 3}") for i in range(3000)]
    rows += [(9000 + i, t, g, "s0") for i, (g, t) in enumerate(rare)]
    df = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).cache()
    whole, kept = df.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("probability"))).first()
    assert kept / whole > mixing.BUDGET - 1e-6
    assert df.where("kept").count() > 0.2 * len(rows)
    assert 0 < df.agg(F.min("probability")).first()[0] and df.agg(F.max("probability")).first()[0] == pytest.approx(1)
    got = {r.lang: r.t / kept for r in df.groupBy("lang").agg(F.sum(F.col("tokens") * F.col("probability")).alias("t")).collect()}
    assert all(got[g] == pytest.approx(mixing.LANGUAGES[g], abs=0.02) for g in mixing.LANGUAGES)


# --- odd input for all ----------------------------------------------------------------------------------

def run_all(spark, df, labels):
    yield fingerprints.with_next(df)
    yield sharding.shard(df)
    yield neardup.near_classes(df)
    yield neardup.first_of_class(df)
    yield quality.scored(df, quality.log_ratios(df, labels))
    path = shared_dir(spark, "test-tokens")
    token_files.write_tokens(df, path)
    yield token_files.read_tokens(spark, path)
    yield token_counts.count_tokens(df)
    for make in (language_model.score, substrings.dedup):
        out, chunks = make(df)
        yield out
        chunks.close()
    yield packing.pack(df)
    yield mixing.mix(df)


def test_odd_rows(spark, docs):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 1, None), (7, None, 1)], "doc_id bigint, quality int, toxic int")
    counts = [df.count() for df in run_all(spark, docs(ODD, extra=CLASH), labels)]
    n = len(ODD)
    assert counts[:3] == [n, n, n] and counts[4:9] == [n] * 5 and counts[9] >= n and counts[10] == n
    assert counts[3] == 9  # no words (4 rows), the copies of a..g (3), and seven other texts


def test_empty_table(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [df.count() for df in run_all(spark, docs([], extra=("row",)), labels)] == [0] * 11

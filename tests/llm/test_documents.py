"""Operators on documents against brute force, over texts of every awkward kind."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import decontaminate, line_dedup, near_dup, packing, pii, quality
from starloom.llm.components import components
from starloom.llm.fm_index import FMIndex, WaveletMatrix, suffix_array

WORDS = ["alpha", "Beta", "gamma", "délta", "eps", "zeta9", "eta,", "θ", "iota.", "kappa", "10.0.0.1"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def texts(seed, n=60):
    """Random texts with copies, near copies, shared lines, blanks, NULLs and a long one."""
    r = random.Random(seed)
    line = "This very line is shared by a good many of the documents here"
    out = [None, "", "  \n\t ", "one", "x" * 5000, "word " * 30000]
    base = [r.choice(WORDS) + str(r.randrange(40)) for _ in range(80)]
    for i in range(n):
        words = [r.choice(WORDS) + str(r.randrange(400)) for _ in range(r.randrange(90))]
        if i % 4 == 0:
            words = list(base)
            for _ in range(r.randrange(6)):
                words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
        text = " ".join(words)
        if i % 3 == 0:
            text += "\n" + (line.upper() if i % 2 else f"  {line}\t") + "\nend\n"
        out.append(text)
    return [*out, out[8], out[8], out[10]]


@pytest.fixture(scope="module")
def corpus():
    return [(i * 3 - 20, t) for i, t in enumerate(texts(1))]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    """Extra columns have the names of results; the last row repeats an id and text."""
    rows = [(i, t, "x", 7, True) for i, t in [*corpus, corpus[12]]]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words long, spans boolean")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# ---- lines ------------------------------------------------------------------------
def lines_by_hand(corpus, min_chars=40, min_docs=5):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for i, t in corpus:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in corpus:
        lines = (t or "").split("\n")
        keep = []
        for line in lines:
            k = key(line)
            if len(k) < min_chars or len(holders[k]) < min_docs or max(holders[k]) == i:
                keep.append(line)
        out[i] = ("\n".join(keep), len(lines), len(lines) - len(keep))
    return out


def test_line_dedup(docs, corpus, nothing):
    got = line_dedup.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "kept", "n_words", "spans", "n_lines", "n_dropped"]
    want = lines_by_hand(corpus)
    rows = got.collect()
    assert len(rows) == len(corpus) + 1
    for r in rows:
        assert (r.text, r.n_lines, r.n_dropped) == want[r.doc_id]
    assert sum(r.n_dropped for r in rows) > 5
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_leaves_rows_without_id(spark):
    line = "y" * 50
    rows = [(None, line)] + [(i, f"{line}\nmore") for i in range(5)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in got} == {(None, line), (4, f"{line}\nmore")} | {(i, "more") for i in range(4)}


# ---- near-duplicates --------------------------------------------------------------
def components_by_hand(corpus, size, percent):
    sets = {}
    for i, t in corpus:
        w = lower(t).split()
        n = min(size, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, corpus, size, percent):
    got = near_dup.near_duplicates(docs, size, percent).collect()
    want = components_by_hand(corpus, size, percent)
    assert len(got) == len(corpus) + 1
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    assert len({r.component_id for r in got}) < len(corpus) - 4


def test_near_duplicates_of_a_large_group(spark):
    """Copies of one text, mutated more or less, in which few pairs are links, and copies of copies."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    corpus = []
    for i in range(220):
        words = list(base if i % 5 else corpus[r.randrange(i)][1].split()) if i else list(base)
        for _ in range(r.randrange(9)):
            words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
        if i % 11 == 0:
            words = words[r.randrange(15) :]
        corpus.append((i, " ".join(words)))
    frame = spark.createDataFrame(corpus, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(frame, 3, 85).collect()}
    assert got == components_by_hand(corpus, 3, 85)


def test_near_duplicates_of_little(spark, nothing):
    assert near_dup.near_duplicates(nothing).count() == 0
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (1, None), (3, "A B C D E F")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {
        (None, None, True), (1, 1, True), (2, 2, True), (3, 2, False)
    }


def test_needed_coordinates():
    assert near_dup.needed(1.0) == near_dup.COORDS
    assert 30 < near_dup.needed(0.8) < near_dup.needed(0.85) < 64 * 0.85


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    n = (30, 90, 60)[seed]
    edges = [(r.randrange(n), r.randrange(n)) for _ in range(n)] if seed < 2 else [(i, i + 1) for i in range(n)]
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {x: root(x) for x in parent} and len(got) == len(parent)


# ---- decontamination --------------------------------------------------------------
def hits_by_hand(text, items, window):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    held = {}
    for name, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            held.setdefault(tuple(w[k : k + n]), set()).add(str(name))
    w, hit, found = words(text), set(), set()
    for n in {len(x) for x in held}:
        for k in range(len(w) - n + 1):
            if (names := held.get(tuple(w[k : k + n]))):
                hit.update(range(k, k + n))
                found |= names
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_decontamination(spark, docs, corpus, nothing, block):
    long = [t for _, t in corpus if t and len(t.split()) > 40]
    items = [(1, " ".join(long[3].split()[5:30])), (2, None), (3, "..."), (4, "alpha1 Beta2"), (10, long[5]), (11, long[5])]
    items += [(5, "one"), (5, "one"), (None, "x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [x for x in items if x[0] is not None]
    got = decontaminate.find_contamination(docs, bench, block_bytes=block, shard_bytes=2000).collect()
    assert len(got) == len(corpus) + 1
    text_of = dict(corpus)
    for r in got:
        words, hit, found = hits_by_hand(text_of[r.doc_id], named, 10)
        assert (r.n_words, r.n_hit, r.item_ids, r.n_items) == (words, hit, found, len(found))
        assert r.contaminated == (hit > 0)
        ends = [(s.start, s.end) for s in r.spans]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert sum(r.contaminated for r in got) >= 3
    assert decontaminate.find_contamination(nothing, bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(docs, none).filter("contaminated").count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_index_by_hand(seed):
    r = np.random.default_rng(seed)
    text = r.integers(0, 4, r.integers(1, 60))
    text[-1] = 0
    zeros = np.cumsum(text == 0)
    key = [[(s, zeros[j] if s == 0 else 0) for j, s in enumerate(text) if j >= i] for i in range(text.size)]
    assert suffix_array(text).tolist() == sorted(range(text.size), key=lambda i: key[i])
    tree, where = WaveletMatrix(text, 3), np.arange(text.size + 1)
    for s in range(4):
        assert tree.rank(np.full(where.size, s), where).tolist() == [int((text[:i] == s).sum()) for i in where]
    assert tree.get(np.arange(text.size)).tolist() == text.tolist()
    index = FMIndex(text, 3)
    phrases = np.array([(a, b) for a in (1, 2, 3) for b in (1, 2, 3)])
    low, high = index.search(phrases)
    for p, a, b in zip(phrases.tolist(), low, high, strict=True):
        at = index.locate(np.arange(a, b))
        assert sorted(at.tolist()) == [i for i in range(text.size - 1) if text[i : i + 2].tolist() == p]


# ---- packing ----------------------------------------------------------------------
def test_packing(docs, corpus, nothing):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    got = packing.pack_documents(docs).toPandas()
    want = []
    for i, t in [*corpus, corpus[12]]:
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        for k, (a, b) in enumerate([(0, first), *[(x, x + 2048) for x in range(first, len(ids), 2048)]]):
            part = ids[a:b]
            want.append((i, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)))
    columns = zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32, map(tuple, got.ids), strict=True)
    assert sorted(columns) == sorted(want)
    ordered = got.sort_values(["sequence_id", "offset"])
    placed = ordered.groupby("sequence_id")
    assert (placed.length.sum() <= 2048).all()
    assert (ordered.offset == placed.length.cumsum() - ordered.length).all()
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packing.pack_documents(nothing).count() == 0


def test_fast_encoder_gives_the_same_ids():
    path = public_tokenizers.path
    both = packing.Encoder(path(packing.VOCABULARY), path(packing.RANKS))
    exact = packing.Encoder(path(packing.VOCABULARY), None)
    samples = ["", " ", "a<|endoftext|>b", "it's 12 Ünits\r\n\r\n  x", "日本 語 　x", "\x1c\x85 y", "'ll don't I'M", "ß" * 99]
    samples += [t for t in texts(3) if t and len(t) < 4000]
    assert [both(t) for t in samples] == [exact(t) for t in samples]


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_once(seed):
    r = np.random.default_rng(seed)
    size = int(r.integers(1, 64))
    counts = np.bincount(r.integers(1, size + 1, r.integers(0, 400)), minlength=size + 1)
    plan = packing.plan_patterns(counts, size)
    held = np.zeros_like(counts)
    for pattern, times in plan:
        assert sum(pattern) <= size and times > 0
        for n in pattern:
            held[n] += times
    assert (held == counts).all()
    table = packing.slots(plan)
    assert sum(m for m in table[:, 2]) == sum(len(p) for p, _ in plan)


@pytest.mark.parametrize(
    "lengths, most",
    [({900: 60_000, 550: 120_000}, 60_000), ({900: 1001, 550: 2002}, 1001), ({700: 9000, 640: 9000}, 6000),
     ({2048: 5, 1: 3}, 6), ({600: 3000}, 1000), ({1024: 7}, 4), ({1500: 10, 500: 10, 40: 10}, 10)],
)
def test_plan_of_lengths_that_fill_no_sequence(lengths, most):
    counts = np.zeros(2049, np.int64)
    counts[list(lengths)] = list(lengths.values())
    plan = packing.plan_patterns(counts, 2048)
    held = np.zeros_like(counts)
    for pattern, times in plan:
        assert sum(pattern) <= 2048 and times > 0
        np.add.at(held, list(pattern), times)
    assert (held == counts).all()
    assert sum(times for _, times in plan) <= most * 1.001 + 2


def test_plan_of_hot_lengths_among_many():
    r = np.random.default_rng(0)
    rare = r.integers(1, 2049, 20_000)
    counts = np.bincount(np.r_[np.full(60_000, 900), np.full(120_000, 550), rare], minlength=2049)
    plan = packing.plan_patterns(counts, 2048)
    # Best fit alone needs 17 % more sequences than the tokens would fill.
    assert sum(times for _, times in plan) * 2048 <= 1.05 * (counts @ np.arange(2049))


# ---- quality ----------------------------------------------------------------------
def counts_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_quality_counts(corpus):
    reader = quality.Reader()
    odd = ["a b c a b c", "#|&\n#|&\n \n \nx\x0by", "a a a a", "a b", "é b c d é b c x", "\x1c"]
    for text in [*odd, *[t for _, t in corpus if not t or len(t) < 9000]]:
        assert reader.counts(text) == counts_by_hand(text), text
    assert reader.counts("word " * 30000) == (30000, 120000, 0, 0, 30000)


def test_quality_model_on_held_out_rows(spark, folder):
    """Trained on the small corpus, it tells labelled rows it has not seen apart."""
    docs = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/labels.parquet")
    known = labels.filter("doc_id % 3 <> 0")
    judged = quality.quality_rules(docs, known)
    assert judged.count() == docs.count()
    rest = judged.filter("NOT base_failed").join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    right = [(r.p_good >= quality.MIN_GOOD) == bool(r.quality) for r in rest]
    assert len(right) > 80 and np.mean(right) > 0.95
    assert np.mean([r.kept for r in rest if r.quality and not r.toxic]) > 0.95


def verdict_by_hand(text, good, bad):
    """Probabilities and verdict by plain loops over words, pairs and byte n-grams."""
    odd, whole, half = 0x9E3779B97F4A7C15, (1 << 64) - 1, quality.BUCKETS // 2
    h = [xxhash.xxh3_64_intdigest(w.encode()) for w in re.findall("[a-z\x80-\U0010ffff]+", lower(text))]
    words = [x % half for x in h]
    words += [((((a * odd & whole) ^ b) * odd & whole) >> 20) % half + half for a, b in zip(h, h[1:], strict=False)]
    raw, chars = (text or "").encode(), []
    for n in quality.CHARS:
        for i in range(len(raw) - n + 1):
            x = 0
            for c in raw[i : i + n]:
                x = (x * 0x01000193 & 0xFFFFFFFF) ^ c
            chars.append(((x ^ (x >> 15)) * 0x85EBCA6B & 0xFFFFFFFF) >> 15)
    score = sum(sum(float(w[i]) for i in at) / len(at) for w, at in ((good.words, words), (good.chars, chars)) if at)
    toxic = sum(float(bad.words[i]) for i in set(words))
    p_good, p_toxic = (1 / (1 + math.exp(-max(-30, min(30, m.a * x + m.b)))) for m, x in ((good, score), (bad, toxic)))
    n, _, _, _, repeated = counts_by_hand(text)
    failed = n < 50 or repeated * 100 > n * 50
    return p_good, p_toxic, not failed and p_good >= quality.MIN_GOOD and p_toxic <= quality.MAX_TOXIC


def test_quality_verdict_by_hand(spark, folder, corpus):
    """Scores, calibration and verdict of labelled, unlabelled and odd texts against plain loops."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good, bad = quality.train(docs, labels)
    assert np.abs(good.chars).sum() > 0
    odd = spark.createDataFrame([(-i - 1, t) for i, (_, t) in enumerate(corpus)], docs.schema)
    seen = set()
    for r in quality.judge(docs.unionByName(odd), (good, bad)).collect():
        if len(r.text or "") > 3000:
            continue
        p_good, p_toxic, kept = verdict_by_hand(r.text, good, bad)
        assert (r.p_good, r.p_toxic) == pytest.approx((p_good, p_toxic), rel=1e-6, abs=1e-9)
        assert r.kept == kept
        seen.add((r.base_failed, kept))
    assert seen == {(True, False), (False, False), (False, True)}


def test_quality_of_odd_tables(spark, docs, corpus, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(docs, none)
    assert got.columns[:2] == ["doc_id", "text"] and len(set(got.columns)) == len(got.columns)
    rows = got.collect()
    assert len(rows) == len(corpus) + 1
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or r.n_repeat_words * 100 > r.n_words * 50)
        assert r.kept == (not r.base_failed)
    labels = spark.createDataFrame([(None, 1, 0), (4, None, 1), (7, 1, 0), (7, 1, 0), (10**9, 0, 1)], none.schema)
    assert quality.quality_rules(docs, labels).count() == len(corpus) + 1
    assert quality.quality_rules(nothing, labels).count() == 0


# ---- personal data ----------------------------------------------------------------
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])]
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and sum(double) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans(spark, corpus):
    r = random.Random(4)
    parts = ["a.b@c.d", "@", "x@y", "é", "1.2.3.4", "256.1.1.1", "00255.1.1.1", "4111 1111 1111 1111", "4111111111111112",
             "+1 (212) 555-0000", "+", "12", "-", " ", "\n", "a_@b.c.", "._x@d.e", " ", "😀", "+49 30 1234567 ", "5.", "(", "a-b.c"]
    rows = ["".join(r.choice(parts) for _ in range(r.randrange(1, 9))) for _ in range(400)]
    rows += ["1" * 20000, "a" * 20000 + "@", "+" + "1 " * 9000, "9-" * 9000 + "9", "1." * 9000, None, ""]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = pii.find_personal_data(frame).select("doc_id", pii.spans_text(F.col("base")).alias("s")).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.s == base_by_hand(rows[x.doc_id]), rows[x.doc_id][:200]


def test_contexts_find_unseen_identifiers(spark, nothing):
    """Numbers with the seeds' word and shape are found, others are not."""
    def card(i):
        body = f"4{i:014d}"
        for last in range(10):
            if base_by_hand(body + str(last)).startswith("card"):
                return body + str(last)

    rows = [f"pay with card: {card(i * 7919)} now" for i in range(60)]
    bad = str(int(card(3)) + 1)
    rows += [f"pay with card: {bad} now", f"part number {bad}x99-1 here", "build 20240101123 of 1234567"]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.found for r in pii.find_personal_data(frame).collect()}
    assert [(s.start, s.end, s.kind) for s in got[60]] == [(15, 31, "id")]
    assert not got[61] and not got[62] and not any(got[i] for i in range(60))
    assert pii.find_personal_data(nothing).count() == 0


def test_identifiers_beside_signs(spark):
    """Tokens are instances whatever sign stands before or after them, and only those of the same run are theirs."""
    signs = [".", "-", "_", "+", "@", ",", "...", "-.", ")", ""]
    rows = [f"My id is {a}AB1234-56{b}{gap}and x1" for a in signs for b in signs for gap in (" ", "\n")]
    rows += ["a-b-c-12 A1234 " + "x-" * 20000, "." * 40 + "AB1234-56."]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    seen = pii._candidates(F.col("text"), F.array().cast("array<struct<start:int,end:int>>"))
    for r in frame.select("text", seen.alias("seen")).collect():
        at = r.text.find("AB1234-56")
        assert [(c.start, c.end) for c in r.seen] == ([(at, at + 9)] if at >= 0 else [])
    # The seeds end a sentence, and so does what they find.
    rows = [f"write to u{i}1234@example.org. Thanks" for i in range(50)] + ["write to u991234@example. Thanks"]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert pii.find_personal_data(frame).filter("size(base) = 1").count() == 50
    seeds = frame.select(pii._candidates(F.col("text"), pii.base_spans(F.col("text"))).alias("seen"))
    assert [[c.seed for c in r.seen] for r in seeds.collect()] == [[True]] * 50 + [[False]]


def test_contexts_settle_with_real_scores(spark):
    """A chain of nine patterns is followed to its end; scores wear off along it."""
    edges = [(k, 1000 * k + i) for k in range(1, 10) for i in range(17)]  # 17 seeds each
    edges += [(k, -k - d) for k in range(1, 10) for d in (0, 1)]  # -k is reached by the one before
    seeds = [(i,) for k, i in edges if i > 0] + [(-1,)]
    edges += [(20, -k) for k in range(2, 11)] + [(20, -50)]  # nine of ten, none of them certain
    edges += [(30, i) for i in range(-63, -60)] + [(30, 1000), (30, 1001), (30, 1002)]  # half
    graph = spark.createDataFrame(edges, "pattern long, instance long")
    known = spark.createDataFrame(seeds, "instance long")
    got = {r.instance: r.score for r in pii.score_instances(graph, known).collect()}
    want, score = {}, 1.0
    for k in range(2, 11):
        score = want[-k] = (17 + score) / 19
    assert got == pytest.approx(want)
    assert {r.instance for r in pii.score_instances(graph, known, rounds=3).collect()} == {-2, -3, -4}


def test_digest_of_components_is_stable(docs):
    """Classes are named by content, so a second run gives the same rows."""
    runs = [sorted(map(tuple, near_dup.near_duplicates(docs).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
    assert hashlib.sha256(repr(runs[0]).encode()).hexdigest()


# ---- many hits in one text ----------------------------------------------------------
def test_lines_of_long_texts(spark):
    """Thousands of shared lines in one text; rows that share an id but not their text."""
    lines = [f"line {i:06d} that several documents hold in common" for i in range(8000)]
    rows = [(k, "\n".join(lines)) for k in range(5)]
    rows += [(2, "\n".join(["own", *lines[:3], "", lines[0]])), (2, rows[2][1])]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((x.doc_id, x.n_lines, x.n_dropped, x.text) for x in got)
    whole = [(k, 8000, 8000, "") for k in (0, 1, 2, 2, 3)]
    assert found == sorted([*whole, (2, 6, 4, "own\n"), (4, 8000, 0, rows[4][1])])


def test_personal_data_of_long_texts(spark):
    """Twenty thousand addresses in one text, and their places."""
    n = 20000
    text = " ".join(f"user{i}4567@mail.example.com" for i in range(n))
    spans = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    base = spans.select("base").first()[0]
    want, at = [], 0
    for word in text.split(" "):
        want.append((at, at + len(word), "email"))
        at += len(word) + 1
    assert [(s.start, s.end, s.kind) for s in base] == want


def test_tokens_touch_base_spans(spark):
    """Whether a token shares a sign with a base span, against all pairs; long and non-ASCII contexts."""
    r = random.Random(9)
    parts = ["AB12345", "x@y.example", "+49 (30) 1234567", "é", "日本語", "4111 1111 1111 1111", "10.2.3.4", "..ID-9876.", "=", '"', "\n"]
    texts = ["".join(r.choice(parts) + r.choice(["", " ", " " * 40]) for _ in range(r.randint(0, 30))) for _ in range(150)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    read = frame.select("text", pii.base_spans(F.col("text")).alias("base"))
    for x in read.select("text", "base", pii._candidates(F.col("text"), F.col("base")).alias("seen")).collect():
        for b in x.base:
            assert x.text[b.start : b.end] == b.text
        for c in x.seen:
            assert c.seed == any(b.start < c.end and c.start < b.end for b in x.base)


def test_decontamination_in_blocks(spark):
    """Many blocks of items, a map column, clashing names and repeated rows: as with one block."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(30)]
    items = [(i, " ".join(texts[i].split()[3:16])) for i in range(0, 30, 2)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, t, {"k": i}, "old", 1.5) for i, t in enumerate(texts)]
    rows += [rows[4], (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, spans string, __row double")
    one = decontaminate.find_contamination(docs, bench)
    many = decontaminate.find_contamination(docs, bench, block_bytes=1, shard_bytes=500)
    assert many.schema == one.schema
    assert sorted(map(str, many.collect())) == sorted(map(str, one.collect()))
    assert one.filter("contaminated").count() > 10
    assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(3))
def test_bootstrapping_by_hand(spark, seed):
    """Scores of the pattern-instance graph against plain loops over dictionaries."""
    r = random.Random(seed)
    edges = {(p, r.randrange(p, p + 12)) for p in range(0, 60, 2) for _ in range(r.randint(1, 14))}
    seeds = {i for i in range(72) if i < 8 or r.random() < 0.1}
    members = {}
    for p, i in edges:
        members.setdefault(p, set()).add(i)
    known, used, support, score = dict.fromkeys(seeds, 1.0), set(), 2, 0.55
    while True:
        new = {}
        for p in members.keys() - used:
            held = [known[i] for i in members[p] if i in known]
            if len(held) >= support and sum(held) >= len(members[p]) * score - 1e-9:
                used.add(p)
                for i in members[p] - known.keys():
                    new[i] = max(new.get(i, 0), sum(held) / len(members[p]))
        if not new:
            break
        known |= new
    frame = spark.createDataFrame(sorted(edges), "pattern long, instance long")
    start = spark.createDataFrame([(i,) for i in sorted(seeds)], "instance long")
    got = {x.instance: x.score for x in pii.score_instances(frame, start, None, support, score).collect()}
    assert got.keys() == known.keys() - seeds
    assert all(abs(got[i] - known[i]) < 1e-9 for i in got)

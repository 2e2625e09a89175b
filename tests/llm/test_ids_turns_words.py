"""Token files with their hash index, conversation repair and spelling variants, by brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import spelling, token_files, turn_repair
from starloom.session import scratch_path

# ---- token files ------------------------------------------------------------------
ODD = [
    "", " ", "a <|endoftext|> b", "x<|endoftext|>y", "<|startoftext|>", "É Ñandú ÇA ßß*** İstanbul ǅ", "é ́x",
    "it's o'll 'RE we'd 12 345 ½ ² µm", "日本語 テキスト", "a b c\x1cd\x85e", "\x00nul\x00", "🙂🙂 ok", "tab\tnew\nline\r\n",
    "x" * 70_000, "word " * 30_000, "## #! !!! ,,, ...",
]


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))


def encoded(exact, text):
    return [*exact.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]


def stored(spark, docs, **how):
    base = scratch_path(spark, "ids")
    token_files.write_files(docs, f"{base}/files", **how)
    placed = token_files.placed_documents(spark, f"{base}/files", docs.schema["doc_id"].dataType)
    token_files.build_index(placed, f"{base}/index", bucket=64)
    return f"{base}/files", f"{base}/index"


def test_encoder_equals_the_library(spark, folder, exact):
    texts = [r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()] + ODD
    encode = token_files.WordEncoder(public_tokenizers.path(token_files.VOCABULARY))
    for text in [*texts, *sorted({w for t in texts for w in re.findall(r"\w+|\W+", t)})]:
        assert np.frombuffer(encode(text), "<u2").tolist() == encoded(exact, text)[:-1], text[:50]


def test_a_worker_makes_its_encoder_once(spark, exact):
    """Tasks of one worker share an encoder, and what it remembers changes no ids."""
    vocabulary = public_tokenizers.path(token_files.VOCABULARY)
    encode = token_files.encoder_of(vocabulary)
    assert token_files.encoder_of(vocabulary) is encode
    for text in (" \t a\r\n\nb  c ", "a\x0bb\x1cc\x85d\u00a0e", "\n", "a \u3000 b") * 2:
        assert np.frombuffer(encode(text), "<u2").tolist() == encoded(exact, text)[:-1], text


@pytest.mark.parametrize("chunk", [token_files.CHUNK_BYTES, 3_000])
def test_digests_by_key(spark, folder, exact, chunk):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate([*ODD, None])], docs.schema)
    docs = docs.unionByName(odd)
    files, index = stored(spark, docs, chunk_bytes=chunk)
    got = sorted(map(tuple, token_files.keyed_digests(spark, files, index, docs, "doc_id").collect()))
    want, start = [], 0
    for i, text in sorted((r.doc_id, r.text) for r in docs.collect()):
        ids = encoded(exact, text)
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    asked = spark.createDataFrame([(i,) for i in (want[3][0], want[3][0], want[-1][0], -5, 10**12)], "key long")
    located = token_files.locate(spark, index, asked)
    cut = {r.key: r.ids for r in token_files.fetch(spark, files, located).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert cut == {i: encoded(exact, texts[i]) for i in (want[3][0], want[-1][0])}


def test_repeated_and_null_keys(spark, exact):
    """Repeated keys follow one another, NULL first; string keys and clashing columns do no harm."""
    rows = [("b", "two"), ("a", "one"), (None, "none"), ("b", "two"), ("b", None), (None, "none"), ("a", "x" * 50)] * 3
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], "doc_id string, text string, key string, part int, copy int")
    files, index = stored(spark, docs, chunk_bytes=100)
    got = token_files.keyed_digests(spark, files, index, docs, "doc_id").collect()
    got = sorted((tuple(r) for r in got), key=lambda r: r[1])
    assert [r[0] for r in got] == [None] * 6 + ["a"] * 6 + ["b"] * 9
    assert [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(len(got))]
    digests = Counter((r[0], r[2], r[3]) for r in got)
    ids = [(key, encoded(exact, text)) for key, text in rows]
    assert digests == Counter((k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in ids)
    located = token_files.locate(spark, index, docs.select(F.col("doc_id").alias("key")))
    assert sorted(r.n_tokens for r in located.collect())[-1] <= 60 and located.count() == 3


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    files, index = stored(spark, docs)
    assert token_files.keyed_digests(spark, files, index, docs, "doc_id").collect() == []


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 63, 5_000):
        h1, h2 = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
        sizes, bits = token_files.perfect_hash(h1, h2)
        assert sorted(token_files.slots(sizes, bits, h1, h2)) == list(range(n))
    with pytest.raises(ValueError, match="share"):
        token_files.perfect_hash(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


# ---- conversation repair ----------------------------------------------------------
SPACES = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def repaired_by_hand(rows):
    """Forward over rows: per last initial the least cost, then the least audit."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.strip(SPACES)
        faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    follows, name = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def offer(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def add_turns():
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                offer(best, follows[state], (cost + 2, audit + "I", (*lines, f"{name[follows[state]]}:")))

    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        add_turns()
        after = {}
        for state, (cost, audit, lines) in best.items():
            offer(after, state, (cost + 3, audit + "D", lines))
            if fault in (0, 3):
                kept = (cost + (fault == 3), audit + "K", (*lines, f"{role}:{text}"))
                if role[:1] == follows[state] or (role[:1], state) == ("s", ""):
                    offer(after, role[:1], kept)
                line = f"{name[follows[state]]}:{text}"
                offer(after, follows[state], (cost + 2 + (fault == 3), audit + "R", (*lines, line)))
        best = after
    add_turns()
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    text = "\n".join(lines).encode()
    return gaps, *[faults.count(i) for i in (1, 2, 3)], illegal, cost, audit, hashlib.sha256(text).hexdigest()


def grouped(rows):
    by = defaultdict(list)
    for row in rows:
        by[row[0]].append(row)
    return by


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    texts = ["a.", "b", "Hi!", "", "  ", None, "x?", "ok. ", "é\n"]
    return [
        (conv, rng.choice([None, t, t, t, t // 2]), rng.choice(roles), rng.choice([*texts, f"{t}.", f"{t}!", f"{t}"]))
        for conv in [None, *range(40)]
        for t in range(rng.choice([1, 2, 3, 5, 9, 40, 200]))
    ]


SPOKEN = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [5, 64, turn_repair.BLOCK])
def test_repair_by_hand(spark, talks, block):
    """Also where conversations cross many blocks."""
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in talks]
    want = {c: repaired_by_hand(rows) for c, rows in grouped(plain).items()}
    got = turn_repair.repair(spark.createDataFrame(talks, SPOKEN), block).collect()
    assert len(got) == len(want) and {r[0]: tuple(r)[1:] for r in got} == want


def test_repair_of_damaged_by_hand(spark, folder, talks):
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    for rows in (given, talks):
        left = grouped(damaged_by_hand(rows))
        want = {c: repaired_by_hand(left[c]) if c in left else (0, 0, 0, 0, 0, 0, "", EMPTY) for c in grouped(rows)}
        turns = spark.createDataFrame([(*r, 1, "s") for r in rows], SPOKEN + ", slot int, block string")
        got = turn_repair.repair_damaged(turns).collect()
        assert len(got) == len(want) and {r[0]: tuple(r)[1:] for r in got} == want


def test_repair_of_one_long_conversation(spark):
    """Many equal rows, long texts, and no rows at all."""
    rows = [(1, None, "user", "x" * 100_000 + ".")] * 40 + [(1, i, "assistant", f"{i}.") for i in range(3_000)]
    got = turn_repair.repair(spark.createDataFrame(rows, SPOKEN), block=256).collect()
    assert [tuple(r)[1:] for r in got] == [repaired_by_hand(rows)]
    empty = spark.createDataFrame([], SPOKEN)
    assert turn_repair.repair_damaged(empty).collect() == []


# ---- spelling variants ------------------------------------------------------------
def words_by_hand(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({k: k + 32 for k in range(65, 91)})
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    return {w: n for w, n in counts.items() if n >= 5}


def spellings_by_hand(words):
    near, same = {w: set() for w in words}, defaultdict(set)
    for w in words:
        for i in range(len(w)):
            same[w[:i] + "*" + w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in near:
                near[w].add(short)
                near[short].add(w)
    for group in same.values():
        for w in group:
            near[w] |= group - {w}
    form = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: f if f and words[f] >= 5 * words[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def made_words():
    rng = random.Random(1)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))): rng.choice([5, 5, 30, 200, 1500]) for _ in range(1500)}
    # One beginning that many words share, so that its key takes several indexes.
    words |= {"abcdef" + "".join(rng.choice("uvwxyz") for _ in range(3)): rng.choice([5, 40]) for _ in range(400)}
    words |= {"ÿ×÷àaa": 9, "ÿ×÷àaab": 99, "aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "zzzzzz" * 50: 6, "zzzzzz" * 50 + "y": 60}
    return words


def test_index_finds_every_near_word():
    words = made_words()
    index, known = spelling.WordIndex(list(words)), list(words)
    found = {w: set() for w in known}
    for side in spelling.SIDES:
        for kind in (spelling.DELETED, spelling.REPLACED, spelling.INSERTED):
            for at, word in zip(*index.one_error(known, side, kind), strict=True):
                found[known[at]].add(index.words[word])
    assert {w: len(v) for w, v in found.items()} == {w: v[3] for w, v in spellings_by_hand(words).items()}
    order = spelling.suffix_order(np.array([2, 3, 2, 3, 2, 0], np.uint8))
    assert order.tolist() == [5, 4, 2, 0, 3, 1]


@pytest.mark.parametrize("index_words", [50, spelling.INDEX_WORDS])
def test_spellings_by_hand(spark, index_words):
    words = made_words()
    vocabulary = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.group_spellings(vocabulary, index_words=index_words).collect()
    assert len(got) == len(words) and {r[0]: tuple(r)[1:] for r in got} == spellings_by_hand(words)


def test_words_by_hand(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(None, "Straße straße STRAßE " * 9), (7, None), (8, ""), (9, "Élèvélève " * 700), (None, "日本abcdef語" * 5)]
    docs += [(i, "abcdefgh ABCDEFGH " * 3) for i in range(900)]
    table = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, n int")
    assert {r.word: r.n for r in spelling.count_words(table).collect()} == words_by_hand(docs)
    empty = spelling.count_words(table.limit(0))
    assert spelling.group_spellings(empty).collect() == []


def test_roots_follow_long_chains(spark):
    links = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(100)], "word string, root string")
    assert {r.root for r in spelling.follow(links).collect()} == {"w100"}

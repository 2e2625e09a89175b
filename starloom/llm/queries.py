"""One registered query per corpus operator, over whole tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    chat,
    decontaminate,
    html_text,
    line_dedup,
    near_dup,
    packing,
    pii,
    quality,
    spelling,
    token_files,
    turn_repair,
    url_graph,
    warc,
)
from starloom.llm.common import table
from starloom.session import remove_intermediate, scratch_path

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), keep_ids=False)


@query
def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages").select("page_id", "html"))


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality.quality_rules(docs, table(spark, folder, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "p_good", "p_toxic")


@query
def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.sql(
        "SELECT bigint(-7) AS conv_id, bigint(turn) AS turn, role, '</s>[INST] ok [/INST]' AS text"
        " FROM VALUES (0, 'user'), (1, 'assistant') AS t (turn, role)"
    )
    turns = table(spark, folder, "conversations").select(*extra.columns).unionByName(extra)
    made = chat.format_conversations(turns)
    read = made.withColumn("turns", chat.read_turns(F.col("formatted")))
    read = read.withColumn("learned", chat.loss_text(F.col("segments")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


ORACLES["op2_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), moved AS (
    SELECT *, lag(role, 1, '-') OVER w AS before, lead(role, 1, '-') OVER w AS after
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), escaped AS (
    SELECT *, length('<|turn|>' || role || '<|text|><|end|>') + length(text)
        + len(regexp_extract_all(text, '\\|<\|turn\|>|<\|text\|>|<\|end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|endoftext\|>'))
        AS chars,
        before || '>' || role IN ('->system', '->user', 'system>user', 'user>assistant',
            'assistant>user', 'assistant>tool', 'tool>assistant')
        AND (after <> '-' OR role = 'assistant') AS fine
    FROM moved
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(CAST(sum(length(text)) FILTER (role = 'assistant') AS BIGINT), 0) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(fine) AS valid
FROM escaped GROUP BY conv_id
"""


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive, files = scratch_path(spark, "archive"), scratch_path(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), archive)
    warc.write_warc(warc.read_archive(spark, archive), files)
    remove_intermediate(spark, archive)
    return warc.describe_files(spark, files)


ORACLES["op5_warc"] = r"""
WITH records AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
), coded AS (
    SELECT page_id, payload, array_to_string(list_transform(range(0, 32), lambda i:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(
            (CAST('0x' || digest[CAST(1 + i * 5 // 4 AS INT) : CAST(2 + i * 5 // 4 AS INT)] AS INT)
            // CAST(power(2, 3 - i * 5 % 4) AS INT)) % 32 AS INT)]), '') AS payload_digest,
        min(page_id) OVER (PARTITION BY payload) AS original
    FROM records
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> original THEN original END AS refers_to
FROM coded
"""


@query
def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"), shingle=3, percent=85)


ORACLES["op6_minhash_near_dedup"] = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[pos : pos + size - 1], ' ') AS shingle
    FROM (SELECT doc_id, words, least(3, len(words)) AS size,
            unnest(range(1, len(words) - least(3, len(words)) + 2)) AS pos
          FROM split WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles AS a JOIN shingles AS b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT c.a, c.b FROM common AS c JOIN sizes AS x ON x.doc_id = c.a JOIN sizes AS y ON y.doc_id = c.b
    WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS seen FROM documents
    UNION SELECT r.doc_id, e.b FROM reach AS r JOIN edges AS e ON e.a = r.seen
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(seen) AS component_id,
    r.doc_id = min(seen) AS kept
FROM reach AS r LEFT JOIN sizes AS s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query
def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_graph.filter_urls(table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(pii.by_start(F.concat("base", "found"))).alias("spans"),
    )


@query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, folder, "benchmark"))
    items = F.array_join("item_ids", ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(items, 256).alias("items_sha256"),
        "contaminated",
    )


ORACLES["op9_decontamination"] = r"""
WITH texts AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'b', item_id, text FROM benchmark
), split AS (
    SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM texts
), windows AS (
    SELECT kind, id, pos, size, array_to_string(words[pos : pos + size - 1], ' ') AS phrase
    FROM (
        SELECT kind, id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM split, (SELECT DISTINCT least(10, len(words)) AS size FROM split
                     WHERE kind = 'b' AND len(words) > 0) AS sizes
        WHERE len(words) >= size AND (kind = 'd' OR size = least(10, len(words)))
    )
), phrases AS (
    SELECT DISTINCT size, phrase, id AS item FROM windows WHERE kind = 'b'
), found AS (
    SELECT w.id, w.pos, w.size, p.item
    FROM windows AS w JOIN phrases AS p USING (size, phrase) WHERE w.kind = 'd'
), hit AS (
    SELECT id, count(DISTINCT place) AS n_hit
    FROM (SELECT id, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY id
), items AS (
    SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM found) GROUP BY id
)
SELECT s.id AS doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM split AS s LEFT JOIN hit ON hit.id = s.id LEFT JOIN items ON items.id = s.id
WHERE s.kind = 'd'
"""


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


ORACLES["op10_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines,
    count(*) FILTER (keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
        FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key)
GROUP BY doc_id
"""


@query
def op11_token_id_output(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    base = scratch_path(spark, "ids")
    files, index = f"{base}/files", f"{base}/index"
    token_files.write_files(docs, files)
    kind = docs.schema["doc_id"].dataType
    token_files.build_index(token_files.placed_documents(spark, files, kind), index)
    return token_files.keyed_digests(spark, files, index, docs, "doc_id")


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair_damaged(table(spark, folder, "conversations"))


def crc32_sql(text: str) -> str:
    """The CRC-32 of a text's UTF-8, a bit at a time."""
    byte = f"CAST('0x' || substr(hex(encode({text})), CAST(1 + j // 4 AS BIGINT), 2) AS BIGINT)"
    bits = f"list_transform(range(0, 8 * strlen({text})), lambda j: CASE WHEN j % 8 = 0 THEN {byte} ELSE 0 END)"
    fold = "lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bits}), {fold}), 4294967295)"


def _state(cost: str, audit: str, lines: str) -> str:
    return f"{{'c': CAST({cost} AS BIGINT), 'p': {audit}, 'l': {lines}}}"


def _edit(state: str, letter: str, cost: str, line: str | None = None) -> str:
    lines = f"list_append(q.{state}.l, {line})" if line else f"q.{state}.l"
    return _state(f"q.{state}.c + {cost}", f"q.{state}.p || '{letter}'", lines)


def _repair_sql() -> str:
    """One fold over a conversation's rows: per state the least cost, then the least audit."""
    cut = "CASE w.k WHEN 3 THEN 1 ELSE 0 END"
    usable, never = "w.k IN (0, 3)", "1000000000"

    def when(test: str) -> str:
        return f"CASE WHEN {usable} AND {test} THEN {cut} ELSE {never} END"

    def step(**new: list[str]) -> str:
        parts = [f"'{n}': " + (f"list_min([{', '.join(new[n])}])" if n in new else f"q.{n}") for n in "esua"]
        return "{" + ", ".join(parts) + ", 'k': w.k, 'r': w.r, 'x': w.x}"

    own, first = "w.r || ':' || w.x", "left(w.r, 1)"
    added = {"u": [_edit(n, "I", "2", "'user:'") for n in "esa"], "a": [_edit("u", "I", "2", "'assistant:'")]}
    rows = step(
        e=[_edit("e", "D", "3")],
        s=[_edit("s", "D", "3"), _edit("e", "K", when(f"{first} = 's'"), own)],
        u=[
            _edit("u", "D", "3"),
            *[_edit(n, "K", when(f"{first} = 'u'"), own) for n in "esa"],
            *[_edit(n, "R", "2 + " + when("true"), "'user:' || w.x") for n in "esa"],
        ],
        a=[
            _edit("a", "D", "3"),
            _edit("u", "K", when(f"{first} = 'a'"), own),
            _edit("u", "R", "2 + " + when("true"), "'assistant:' || w.x"),
        ],
    )
    fold = (
        f"CASE w.k WHEN 8 THEN {step(u=['q.u', *added['u']])}"
        f" WHEN 9 THEN {step(a=['q.a', *added['a']])} ELSE {rows} END"
    )
    nothing = "CAST([] AS VARCHAR[])"
    start, closed = _state("0", "''", nothing), _state(never, "''", nothing)

    def element(k: str, r: str, x: str) -> str:
        return f"{{'e': {start}, 's': {closed}, 'u': {closed}, 'a': {closed}, 'k': CAST({k} AS INT), 'r': {r}, 'x': {x}}}"

    key = crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")
    return rf"""
WITH marked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {key} % 20 AS kind
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM marked WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos
    FROM damaged
), judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
    FROM placed
), steps AS (
    SELECT conv_id, pos, 1 AS part, 8 AS k, '' AS r, '' AS x FROM judged
    UNION ALL SELECT conv_id, pos, 2, 9, '', '' FROM judged
    UNION ALL SELECT conv_id, pos, 3, fault, role, text FROM judged
    UNION ALL SELECT DISTINCT conv_id, 1000000000, 1, 8, '', '' FROM judged
    UNION ALL SELECT DISTINCT conv_id, 1000000000, 2, 9, '', '' FROM judged
), folded AS (
    SELECT conv_id, list_reduce(list_concat([{element("0", "''", "''")}],
        list({element("k", "r", "x")} ORDER BY pos, part)), lambda q, w: {fold}) AS q
    FROM steps GROUP BY conv_id
), best AS (
    SELECT conv_id, list_min([q.e, q.a]) AS q FROM folded
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
        count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(q.c, 0) AS cost,
    coalesce(q.p, '') AS audit, sha256(coalesce(array_to_string(q.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS i
LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM i.conv_id
"""


ORACLES["op12_conversation_repair"] = _repair_sql()


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.count_words(table(spark, folder, "documents"))
    return spelling.group_spellings(words)


ORACLES["op13_spelling_variants"] = rf"""
WITH RECURSIVE found AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM found WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT *, {crc32_sql("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM runs
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
        CAST(sum(n) AS BIGINT) AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), cut AS (
    SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words
), replaced AS (
    SELECT word, left(word, i - 1) || '*' || substr(word, i + 1) AS pattern FROM cut
), shorter AS (
    SELECT DISTINCT c.word AS long, w.word AS short
    FROM cut AS c JOIN words AS w ON w.word = left(c.word, c.i - 1) || substr(c.word, c.i + 1)
), near AS (
    SELECT DISTINCT a.word, b.word AS form FROM replaced AS a JOIN replaced AS b USING (pattern) WHERE a.word <> b.word
    UNION ALL SELECT long, short FROM shorter UNION ALL SELECT short, long FROM shorter
), ranked AS (
    SELECT near.word, form, f.n AS form_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY f.n DESC, form) AS place
    FROM near JOIN words AS f ON f.word = form
), judged AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
        CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
    FROM words AS w LEFT JOIN ranked AS r ON r.word = w.word AND place = 1
), chain AS (
    SELECT word, word AS root FROM judged
    UNION ALL SELECT c.word, j.form FROM chain AS c JOIN judged AS j ON j.word = c.root WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n
FROM judged AS j JOIN chain AS c USING (word) JOIN judged AS e ON e.word = c.root AND e.form IS NULL
"""

"""Personal data: fixed patterns, and bootstrapped contexts that find further identifiers.

DataFrame functions only. The fixed patterns give the base spans. Every token with several
digits is an instance, told apart by a hash of its value, and occurs in patterns: the word
before it with its shape, and its shape with the signs around it. Instances under a base
span are the seeds, of score 1. Pattern confidence is the mean score of its distinct instances,
those not trusted counting 0, instance score the best confidence of its patterns; the two are
computed in turn over the stored graph of (pattern, instance) edges until no instance is added.
Instances that reach the threshold are trusted and become spans. They keep the score of
the round that reached them: a pattern that raised its own instances again and again would
bring them all to 1. Texts are read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, materialize, removing_intermediates

#: Base kinds in their order. Possessive where nothing can be given back, and anchored to the
#: beginning of a run, or to the end of the last match, so that long runs cost one look.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
FOUND = "id"
#: A token of at least six characters with at least four digits. Signs before it belong to the match,
#: those after it do not.
TOKEN = (
    r"(?<![A-Za-z0-9._@+-])[._@+-]*+(?=(?:[A-Za-z._@+-]*+[0-9]){4})[A-Za-z0-9][A-Za-z0-9._@+-]{4,}[A-Za-z0-9]"
)
MIN_SUPPORT, MIN_SCORE = 5, 0.9
#: Sums of the same scores in another order differ by less.
ROUNDING = 1e-9
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_SPAN = "array<struct<start:int,kind:int,end:int,text:string>>"


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """``op`` of each value and all before it, by doubled distances: n log n steps, no growing array."""
    distances = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda d: d < F.size(values))
    return F.aggregate(
        distances, values, lambda x, d: F.transform(x, lambda v, i: op(v, F.get(x, i - d)))
    )


def _sums(values: Column) -> Column:
    return _with(values, lambda x: _running(x, lambda v, before: v + F.coalesce(before, F.lit(0))))


def _spans(text: Column, pattern: str, kind: int, guard: Column, context: bool = False) -> Column:
    """Matches of a pattern with their places in code points, from what lies between them.

    With ``context``: also up to 32 signs to their left and the one to their right.
    """

    def place(hits: Column, gaps: Column) -> Column:
        steps = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.length(h))

        def span(hit: Column, i: Column, end: Column) -> Column:
            fields = [
                (end - F.length(hit)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), hit.alias("text")
            ]
            if context:
                near = F.get(gaps, i)
                # Tokens have six signs at least, so six of them reach back far enough.
                back = [F.coalesce(F.get(x, i - j), F.lit("")) for j in range(6, 0, -1) for x in (gaps, hits)]
                left = F.when(F.length(near) >= 32, near).otherwise(F.concat(*[F.substring(x, -32, 32) for x in back], near))
                after = F.get(gaps, i + 1)
                after = F.when(after == "", F.coalesce(F.get(hits, i + 1), F.lit(""))).otherwise(after)
                fields += [F.substring(left, -32, 32).alias("left"), F.substring(after, 1, 1).alias("after")]
            return F.struct(*fields)

        return _with(_sums(steps), lambda ends: F.transform(hits, lambda h, i: span(h, i, F.get(ends, i))))

    def found(hits: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        return F.when(F.size(hits) > 0, _with(gaps, lambda g: place(hits, g)))

    shape = _SPAN if not context else _SPAN.replace("text:string", "text:string,left:string,after:string")
    spans = F.when(guard, _with(F.regexp_extract_all(text, F.lit(pattern), 0), found))
    return F.coalesce(spans, F.array().cast(shape))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    values = F.transform(
        F.sequence(F.lit(1), F.length(back)),
        lambda i: F.when(i % 2 == 1, F.substring(back, i, F.lit(1))).otherwise(
            F.substring(F.lit("0246813579"), F.substring(back, i, F.lit(1)).cast("int") + 1, F.lit(1))
        ).cast("int"),
    )
    return F.aggregate(values, F.lit(0), lambda n, d: n + d) % 10 == 0


def _passes(kind: str) -> Callable[[Column], Column]:
    def check(span: Column) -> Column:
        text = span["text"]
        if kind == "ip":
            return F.rlike(text, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        digits = F.regexp_replace(text, "[^0-9]", "")
        if kind == "card":
            return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
        if kind == "phone":
            return F.length(digits).between(10, 15)
        return F.lit(True)

    return check


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start, then kind."""
    guards = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    found = [
        F.filter(_spans(text, pattern, i, guards.get(kind, F.lit(True))), _passes(kind))
        for i, (kind, pattern) in enumerate(KINDS.items())
    ]
    return F.array_sort(F.concat(*found))


def _shape(token: Column) -> Column:
    """Runs of digits and letters collapsed, with the length; hexadecimal tokens alike."""
    shape = token
    for chars, mark in (("[0-9]", "9"), ("[a-z]", "a"), ("[A-Z]", "A")):
        shape = F.regexp_replace(shape, chars, mark)
    shape = F.regexp_replace(shape, r"(.)\1+", "$1+")
    hexadecimal = F.rlike(token, F.lit("^(?=.*[a-f])[0-9a-f]{16,}$"))
    return F.concat(
        F.when(hexadecimal, F.lit("hex")).otherwise(shape), F.lit(":"), F.length(token).cast("string")
    )


def _touched(spans: Column, base: Column) -> Column:
    """For disjoint spans in their order, whether a base span shares a sign with each.

    One does if, of those that start before the span's end, the furthest goes beyond its start.
    """

    def event(at: Column, base: bool, reach: Column, start: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(int(base)).alias("base"), reach.alias("reach"), start.alias("start"))

    def told(events: Column) -> Column:
        reach = _with(F.transform(events, lambda e: e["reach"]), lambda r: _running(r, F.greatest))
        pairs = F.zip_with(
            events, reach, lambda e, r: F.struct(e["base"].alias("base"), (r > e["start"]).alias("touched"))
        )
        return F.transform(F.filter(pairs, lambda p: p["base"] == 0), lambda p: p["touched"])

    queries = F.transform(spans, lambda s: event(s["end"], False, F.lit(0), s["start"]))
    starts = F.transform(base, lambda b: event(b["start"], True, b["end"], F.lit(0)))
    return _with(F.array_sort(F.concat(queries, starts)), told)


def _candidates(text: Column, base: Column) -> Column:
    """Tokens with digits: place, hash, whether a base span covers them, and their patterns."""

    def describe(span: Column, seed: Column) -> Column:
        word = ascii_lower(F.regexp_extract(span["left"], r"([^\s\"'=:(]*[\s\"'=:(]*)$", 1))
        signs = F.regexp_extract(span["left"], r"([^\w\s]*)\s*$", 1)
        after = F.regexp_extract(span["after"], r"[^\w\s]", 0)
        shape = _shape(span["text"])
        return F.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            F.xxhash64(span["text"]).alias("instance"),
            seed.alias("seed"),
            F.array(
                F.xxhash64(F.lit("word"), word, shape), F.xxhash64(F.lit("signs"), signs, shape, after)
            ).alias("patterns"),
        )

    def bare(match: Column) -> Column:
        signs = F.regexp_extract(match["text"], r"^[._@+-]*", 0)
        left = F.substring(F.concat(match["left"], signs), -32, 32)
        return F.struct(
            (match["start"] + F.length(signs)).alias("start"), match["end"].alias("end"),
            F.substring(match["text"], F.length(signs) + 1, F.length(match["text"])).alias("text"),
            left.alias("left"), match["after"].alias("after"),
        )

    guard = F.rlike(text, F.lit("[0-9]"))
    tokens = F.transform(_spans(text, TOKEN, 0, guard, context=True), bare)
    return _with(
        F.struct(tokens.alias("tokens"), base.alias("base")),
        lambda both: F.zip_with(both["tokens"], _touched(both["tokens"], both["base"]), describe),
    )


def score_instances(
    edges: DataFrame, seeds: DataFrame, rounds: int | None = None, min_support: int = MIN_SUPPORT,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """``instance, score`` of the instances beyond the seeds whose patterns are trusted.

    ``edges``: distinct pattern, instance. ``seeds``: distinct instance. A pattern counts
    once it has ``min_support`` trusted instances and a confidence of at least ``min_score``, which
    all its instances then reach. ``rounds`` bounds the rounds; without it they end when none adds an instance.
    """
    with removing_intermediates(edges.sparkSession):
        # A pattern of too few instances can never count.
        patterns = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_support)
        patterns = patterns.select("pattern", "n", F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("support"))
        patterns = materialize(patterns, "patterns")
        edges = materialize(edges.join(patterns.select("pattern"), "pattern", "left_semi"), "live-graph")
        new = known = seeds.select("instance", F.lit(1.0).alias("score"))
        found, done = None, 0
        while done != rounds:
            gained = edges.join(new, "instance").groupBy("pattern").agg(
                F.sum("score").alias("more"), F.count(F.lit(1)).alias("trusted")
            )
            summed = patterns.join(gained, "pattern", "left").select(
                "pattern", "n", (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
                (F.col("support") + F.coalesce("trusted", F.lit(0))).alias("support"),
            )
            summed = materialize(summed, "patterns")
            counts = (F.col("support") >= min_support) & (F.col("total") >= F.col("n") * (min_score - ROUNDING))
            patterns = summed.filter(~counts)  # of the others all instances are known from here on
            reached = edges.join(summed.filter(counts).select("pattern", (F.col("total") / F.col("n")).alias("score")), "pattern")
            reached = reached.groupBy("instance").agg(F.max("score").alias("score"))
            new = materialize(reached.join(known.select("instance"), "instance", "left_anti"), "instances")
            if new.isEmpty():
                break
            known = known.unionByName(new)
            found = new if found is None else found.unionByName(new)
            done += 1
        found = known.limit(0) if found is None else found
        return materialize(found, "instances", keep=True)


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int | None = None,
    min_support: int = MIN_SUPPORT,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """``id_col, base, found`` for every row of ``docs``: arrays of spans with start, end, kind.

    ``base``: spans of the four fixed kinds, by start, then kind in the order of ``KINDS``.
    ``found``: further identifiers, of kind ``id``, none of which touches a base span. Starts
    and ends count code points, ends are exclusive.

    A NULL or empty text has no spans. Rows are kept one by one, so repeated rows and ids get
    equal spans, and NULL ids pass through. Other columns are not read. An empty table gives
    an empty table; without seeds nothing is found beyond the base.
    """
    plain = docs.select(
        F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text")
    )
    read = plain.withColumn("__base", base_spans(F.col("__text")))
    read = read.withColumn("__seen", _candidates(F.col("__text"), F.col("__base")))
    stored = materialize(read.drop("__text"), "spans", row_id="__row")
    seen = stored.select("__row", F.explode("__seen").alias("c")).select("__row", "c.*")
    edges = materialize(seen.select("instance", F.explode("patterns").alias("pattern")).distinct(), "graph")
    seeds = materialize(seen.filter("seed").select("instance").distinct(), "seeds")
    trusted = score_instances(edges, seeds, rounds, min_support, min_score)
    # A seed's value found elsewhere is as personal there.
    wanted = trusted.select("instance").unionByName(seeds)
    span = F.struct("start", "end", F.lit(FOUND).alias("kind"))
    found = (
        seen.filter("NOT seed")
        .join(wanted, "instance")
        .groupBy("__row")
        .agg(F.array_sort(F.collect_list(span)).alias("found"))
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform(
        "__base",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.element_at(names, s["kind"] + 1).alias("kind"),
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return stored.join(found, "__row", "left").select(
        F.col(f"`{id_col}`"), base.alias("base"), F.coalesce("found", none).alias("found")
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def by_start(spans: Column) -> Column:
    """Spans by start, then kind in the order of ``KINDS``, found ones last."""
    order = F.array(*[F.lit(k) for k in KINDS])

    def rank(s: Column) -> Column:
        place = F.array_position(order, s["kind"])
        return F.when(place == 0, len(KINDS) + 1).otherwise(place)

    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            rank(s).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    return F.array_sort(keyed)

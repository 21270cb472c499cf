"""Secret scan that links the parts of a credential.

Three kinds are certain and always reported: assignments, access identifiers, long hexadecimal runs.
Three more are weak: ``login`` (a user or client name), ``loose`` (an unlabelled random-looking run) and
``endpoint`` (a service address). In ``scheme://user:password@host`` they are the user, the password and the rest.
Parts are near if at most ``scope`` code points lie between them; parts that overlap are never near, so no part is its
own partner. A weak secret counts only near an identifier or an endpoint, a weak identifier only near a secret, and an
endpoint only where both an identifier and a secret are near. A loose run that overlaps a certain span is that span.

The interval join between parts is a range window per document over starts and ends: a part counts the roles
that end up to ``scope`` code points before its start, and those that start as close after its end. No pairs are formed.

Spans are code points, end exclusive. The gaps between the matches of a pattern and the matches
themselves add up to positions; that running sum is a window too, so a text with very many
matches costs no more per match.

Edge cases: null and empty texts have no spans; rows with the same id are scanned one by one; an empty
table gives an empty result; further columns are ignored.

Scale: one scan of the texts, of which only lengths leave the row; rows shuffled are matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import let, stored

# The user and the password of an address such as scheme://user:password@host
USER = r"""[^\x20\x09-\x0D"'<>:@/]{1,64}"""
PASSWORD = r"""[^\x20\x09-\x0D"'<>@/]{1,128}"""
# The certain kinds in the order in which spans of one start are listed, then the weak ones.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "login": r"""(?i)(?:user(?:name)?|login|client_id|access_key_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
             + rf"|(?<=://){USER}(?=:{PASSWORD}@)",
    "loose": rf"(?<=:)(?<=://{USER}:){PASSWORD}(?=@)|[A-Za-z0-9+/=_-]{{20,}}",
    "endpoint": rf"(?<=@)(?<=://{USER}:{PASSWORD}@)" + r"""[^\x20\x09-\x0D"'<>]+"""
                + rf"|(?i)(?:https?|postgres|mysql|redis|amqp|mongodb)://(?!{USER}:{PASSWORD}@)" + r"""[^\x20\x09-\x0D"'<>]+""",
}
KINDS = list(PATTERNS)
CERTAIN = KINDS[:3]
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "login": "id", "loose": "secret", "endpoint": "endpoint"}
MIN_VALUE = 6


def _matches(text: Column, number: int, kind: str) -> Column:
    """Per match in order: kind, rank, code points since the match before, code points, whether it counts."""
    pattern = F.lit(PATTERNS[kind])

    def rows(both: Column) -> Column:
        def valid(m: Column, i: Column) -> Column:
            if kind == "assign":
                return F.length(F.get(both["values"], i)) >= MIN_VALUE
            if kind == "loose":
                return m.rlike("[0-9]") & m.rlike("[A-Za-z]")
            return F.lit(True)

        return F.transform(both["found"], lambda m, i: F.struct(
            F.lit(number).alias("kind"), i.alias("rank"), F.length(F.get(both["gaps"], i)).alias("gap"),
            F.length(m).alias("size"), valid(m, i).alias("valid")))

    parts = [F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"), F.split(text, PATTERNS[kind], -1).alias("gaps")]
    if kind == "assign":
        parts.append(F.regexp_extract_all(text, pattern, F.lit(2)).alias("values"))
    nothing = F.array().cast("array<struct<kind:int,rank:int,gap:int,size:int,valid:boolean>>")
    return F.when(text.rlike(PATTERNS[kind]), let(F.struct(*parts), rows)).otherwise(nothing)


def parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (row, doc_id) of ``docs``, and all matches (row, kind, start, end) that count."""
    text = F.coalesce(F.col("text"), F.lit(""))
    scanned = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.concat(*[_matches(text, i, k) for i, k in enumerate(KINDS)]).alias("matches")), "secret-matches")
    order = Window.partitionBy("row", "kind").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        scanned.filter(F.size("matches") > 0).select("row", F.inline("matches"))
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order))
        .withColumn("start", F.col("end") - F.col("size"))
        .filter("valid").select("row", "kind", "start", "end")
    )
    return scanned.select("row", "doc_id"), spans


def linked(spans: DataFrame, scope: int) -> DataFrame:
    """Certain spans, and those weak ones whose complementary parts lie within the scope."""
    row = Window.partitionBy("row").orderBy("start")
    certain = F.col("kind") < len(CERTAIN)
    apart = (
        spans
        .withColumn("_before", F.max(F.when(certain, F.col("end"))).over(row.rangeBetween(Window.unboundedPreceding, 0)))
        .withColumn("_after", F.min(F.when(certain, F.col("start"))).over(row.rangeBetween(0, Window.unboundedFollowing)))
        .filter(certain | (F.col("kind") != KINDS.index("loose")) |
                ((F.coalesce("_before", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("_after") >= F.col("end"), F.lit(True))))
    )
    # each part as two rows, at its start and its end
    edges = apart.select("row", "kind", "start", "end", F.explode(F.array(F.lit(True), F.lit(False))).alias("_opens")).withColumn(
        "_at", F.when(F.col("_opens"), F.col("start")).otherwise(F.col("end")))
    at = Window.partitionBy("row").orderBy("_at")
    role = F.element_at(F.array(*[F.lit(ROLES[k]) for k in KINDS]), F.col("kind") + 1)
    names = ("id", "secret", "endpoint")
    for name in names:
        edges = edges.withColumn(f"_{name}", F.when(
            F.col("_opens"), F.count(F.when((role == name) & ~F.col("_opens"), 1)).over(at.rangeBetween(-scope, 0))).otherwise(
            F.count(F.when((role == name) & F.col("_opens"), 1)).over(at.rangeBetween(0, scope))))
    apart = edges.groupBy("row", "kind", "start", "end").agg(*[F.sum(f"_{name}").alias(f"_{name}") for name in names])
    beside = (
        F.when(role == "secret", (F.col("_id") > 0) | (F.col("_endpoint") > 0))
        .when(role == "id", F.col("_secret") > 0)
        .otherwise((F.col("_id") > 0) & (F.col("_secret") > 0))
    )
    return apart.filter(certain | beside).select("row", "kind", "start", "end")


def secret_scan(docs: DataFrame, scope: int = 400) -> DataFrame:
    """Per row of ``docs``: doc_id and ``found``, an array of (start, kind number, end), in order."""
    rows, spans = parts(docs)
    found = linked(spans, scope).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    empty = F.array().cast(found.schema["found"].dataType)
    return rows.join(found, "row", "left").select("doc_id", F.coalesce("found", empty).alias("found"))


def listed(found: Column, certain_only: bool = False) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    if certain_only:
        found = F.filter(found, lambda x: x["kind"] < len(CERTAIN))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def count_of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == KINDS.index(kind))).cast("long")

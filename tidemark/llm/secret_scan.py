"""Secrets and who owns them, with DataFrame functions only.

Base spans come from three patterns, leftmost and without overlap per kind, as code point ranges.
Every candidate value is hashed; distinct (value, owner, repository) rows are counted up to the
owners of a value, each step summed on the map side first. A value that ``example_owners`` or more
owners share, or that stands in ``example_repositories`` or more repositories, whoever owns them, is a
copied ``example``; any other value is ``live`` if it is an access key or has enough different
characters. Both add a span over the value itself; base spans stay. Redaction masks every
value that is no copied example, whether it looks live or not: credentials need not hold a digit.

Defined cases: null text is empty; a null owner counts as one owner of its own, so does a null
repository; repeated rows count once per repository; documents without a find are returned too; very
long texts take time in proportion to length and finds; extra columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, materialise, running, table

#: The patterns of the three kinds, in their order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "example", "live")
EXAMPLE, LIVE, OTHER = 3, 4, 5
LEAST_VALUE = 12
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 20
LIVE_CHARACTERS = 8
MASK = "[SECRET]"
PIECE = 1024
SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _spans(kind: int, pattern: str, matches: Column, value: Callable[[Column], Column], keep: Callable[[Column], Column]) -> Column:
    """The spans of ``matches``: each ends where the text between the matches and the matches before it do."""
    between = F.slice(F.split("body", pattern, -1), 1, F.size(matches))
    ends = running(F.zip_with(between, matches, lambda gap, m: F.length(gap) + F.length(m)), lambda x, y: x + y)
    every = F.zip_with(ends, matches, lambda end, m: F.struct(
        (end - F.length(m)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value(m).alias("value")))
    return F.when(F.size(matches) > 0, F.filter(every, keep)).otherwise(F.array()).cast(f"array<{SPAN}>")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(id, more..., key, base array<struct<start,kind,end,value>>): base spans in order of start and kind.

    ``key`` is a digest of id and text; it joins a document with what is found for it.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), *(F.col(c).alias(f"more{i}") for i, c in enumerate(more)),
                       document_key(id_col, text_col).alias("key"), body.alias("body"))
    matched = rows.select("*", *(F.regexp_extract_all("body", F.lit(p), 0).alias(f"m{k}") for k, p in enumerate((ASSIGN, ACCESS, HEX))))
    every, whole = lambda s: F.lit(True), lambda m: m
    base = F.concat(
        _spans(0, ASSIGN, F.col("m0"), lambda m: F.regexp_extract(m, ASSIGN, 2), lambda s: F.length(s["value"]) >= LEAST_VALUE),
        _spans(1, ACCESS, F.col("m1"), whole, every),
        _spans(2, HEX, F.col("m2"), whole, every),
    )
    names = [f"more{i}" for i in range(len(more))]
    return matched.select("id", *names, "key", F.sort_array(base).alias("base"))


def document_key(id_col: str, text_col: str) -> Column:
    parts = (F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    return F.sha2(F.concat_ws("\0", *parts), 256)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repositories) of (hash, owner, repository) rows."""
    once = candidates.select("hash", "owner", "repository").distinct()
    per_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_col: str = "doc_id", example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES, others: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(documents with base spans, (key, added array<struct<start,kind,end,value>>)).

    Both stand on one stored scan of the texts. ``added`` are the example and live spans of a document,
    and with ``others`` also the values that are neither, as spans of kind ``OTHER``.
    """
    found = materialise(find(docs, id_col, text_col, owner_col, repository_col), "secrets")
    span = F.col("span")
    candidates = found.where(F.size("base") > 0).select(
        "key", F.coalesce(F.col("more0").cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col("more1").cast("string"), F.lit("")).alias("repository"), F.explode("base").alias("span"),
    ).withColumn("hash", F.sha2(span["value"], 256))
    value = span["value"]
    live = (span["kind"] == 1) | (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS)
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    kind = F.when(copied, EXAMPLE).when(live, LIVE)
    kind = kind.otherwise(OTHER) if others else kind
    added = (
        candidates.select("key", "hash", "span").distinct()
        .join(ownership(candidates), "hash")
        .select("key", F.struct((span["end"] - F.length(value)).alias("start"), kind.alias("kind"),
                                span["end"].alias("end"), value.alias("value")).alias("more"))
        .where(F.col("more.kind").isNotNull())
        .groupBy("key").agg(F.sort_array(F.collect_set("more")).alias("added"))
    )
    return found, added


def scan(docs: DataFrame, **options) -> DataFrame:
    """(id, base, added) per row of ``docs``."""
    found, added = judged(docs, **options)
    nothing = F.array().cast(f"array<{SPAN}>")
    return found.join(added, "key", "left").select("id", "base", F.coalesce("added", nothing).alias("added"))


def _masked(body: Column, own: Column, mask: str) -> Column:
    """``body`` with ``mask`` for every run of overlapping spans; text is read by pieces, not from its start."""

    def built(pieces: Column, tops: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            at = F.floor(start / PIECE).cast("int")
            near = F.array_join(F.slice(pieces, at + 1, F.floor(end / PIECE).cast("int") - at + 1), "")
            return F.when(end > start, near.substr(start - at * PIECE + 1, end - start)).otherwise("")

        before = lambda k: F.coalesce(F.get(tops, k - 1), F.lit(0))
        fresh = F.transform(own, lambda x, k: F.when(
            x["start"] >= before(k), F.concat(part(before(k), x["start"]), F.lit(mask))).otherwise(""))
        return F.array_join(F.concat(fresh, F.array(part(before(F.size(own)), F.length(body)))), "")

    tops = running(F.transform(own, lambda x: x["end"]), F.greatest)
    return let(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), 0), lambda pieces: let(tops, lambda ends: built(pieces, ends)))


def redact(docs: DataFrame, text_col: str = "text", mask: str = MASK, **options) -> DataFrame:
    """``docs`` with its own columns, every found value that is no copied example replaced by ``mask``."""
    _, added = judged(docs, text_col=text_col, others=True, **options)
    own = added.select("key", F.filter("added", lambda s: s["kind"] != EXAMPLE).alias("own")).where(F.size("own") > 0)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at, id_at = docs.columns.index(text_col), docs.columns.index(options.get("id_col", "doc_id"))
    work = docs.toDF(*names).withColumn("key", document_key(names[id_at], names[at]))
    body = names[at]
    new = F.when(F.col("own").isNotNull(), _masked(F.col(body), F.col("own"), mask)).otherwise(F.col(body))
    joined = work.join(own, "key", "left").withColumn(body, new)
    return joined.select(*names).toDF(*docs.columns)


def listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    text = F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def op5(spark, sf_dir: str) -> DataFrame:
    scanned = scan(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        F.col("id").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


_PATTERNS = (
    r"""[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"""
)
_ASSIGN_SQL = "(" + _PATTERNS + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
OP5_SQL = f"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT r, t, 0 AS k, regexp_extract_all(t, '{_ASSIGN_SQL}', 0) AS ms, regexp_extract_all(t, '{_ASSIGN_SQL}', 2) AS vs FROM base
  UNION ALL SELECT r, t, 1, regexp_extract_all(t, '{ACCESS}', 0), regexp_extract_all(t, '{ACCESS}', 0) FROM base
  UNION ALL SELECT r, t, 2, regexp_extract_all(t, '{HEX}', 0), regexp_extract_all(t, '{HEX}', 0) FROM base),
walk AS (
  SELECT r, k, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS e FROM m WHERE len(ms) > 0
  UNION ALL
  SELECT r, k, i + 1, e + instr(substr(t, e + 1), ms[i + 1]) - 1, e + instr(substr(t, e + 1), ms[i + 1]) - 1 + length(ms[i + 1])
  FROM walk JOIN m USING (r, k) WHERE i < len(ms)),
spans AS (
  SELECT r, k, s, e, vs[i] AS v FROM walk JOIN m USING (r, k) WHERE i > 0 AND (k > 0 OR length(vs[i]) >= {LEAST_VALUE})),
owners AS (
  SELECT v, count(DISTINCT owner) >= {EXAMPLE_OWNERS} OR count(DISTINCT (owner, doc_id)) >= {EXAMPLE_REPOSITORIES} AS copied
  FROM spans JOIN base USING (r) GROUP BY v),
added AS (
  SELECT DISTINCT r, CASE WHEN copied THEN 3 ELSE 4 END AS k, e - length(v) AS s, e
  FROM spans JOIN owners USING (v)
  WHERE copied OR k = 1 OR len(list_distinct(string_split(v, ''))) >= {LIVE_CHARACTERS}),
every AS (SELECT r, k, s, e FROM spans UNION ALL SELECT r, k, s, e FROM added),
named AS (SELECT r, k, s, {list(KINDS)}[k + 1] || ':' || s || ':' || e AS x FROM every),
joined AS (
  SELECT r, count(*) FILTER (WHERE k = 0) AS n0, count(*) FILTER (WHERE k = 1) AS n1, count(*) FILTER (WHERE k = 2) AS n2,
    coalesce(string_agg(x, ',' ORDER BY s, k) FILTER (WHERE k < 3), '') AS b, string_agg(x, ',' ORDER BY s, k) AS a
  FROM named GROUP BY r)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM base LEFT JOIN joined USING (r)
"""

"""Landing, alignment, hashing, dedup, quality and merges."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark import spec as s
from tidemark.functions.columns import row_hash
from tidemark.operators import merge, paging, quality
from tidemark.operators.align import align, main_projection, stamp, union_diagonal, valid_records
from tidemark.operators.dedup import dedup_records
from tidemark.plans.load import load_table
from tidemark.session import scratch
from tidemark.sources.pages import land_pages, list_pages, missing_pages, scan_pages
from tidemark.sources.store import TableStore
from workload import standins as d
from workload.registry import query

NOW = datetime(2026, 9, 8, 20, tzinfo=timezone.utc)
MARKS = "array_to_string(list_transform(marks, lambda x: coalesce(CAST(x AS VARCHAR), '-')), '|') AS marks"


def marks_text(frame):
    return frame.withColumn("marks", F.array_join(F.col("marks").cast("array<string>"), "|", "-"))


# -- landing -----------------------------------------------------------------------


@query(
    "raw_scan_align", "activities",
    sql=f"""SELECT id, "user", name, updated_at, score, CAST(NULL AS VARCHAR) AS note, {MARKS} FROM activities""",
)
def raw_scan_align(spark, sf_dir):
    root = scratch(spark, "raw")
    land_pages(d.activities(spark, sf_dir), d.BULK, root, NOW, s.DEFAULT_START)
    return marks_text(align(scan_pages(spark, d.BULK, f"{root}/{d.BULK.path}"), d.BULK.schema))


@query(
    "page_bounds", "activities",
    sql=f"""WITH r AS (SELECT id, updated_at, row_number() OVER (ORDER BY updated_at, id) - 1 AS n FROM activities),
        pages AS (SELECT n // 500 AS page_no, n // 10000 AS grp, count(*) AS records,
            min(updated_at) AS first_version, max(updated_at) AS last_version, arg_max(id, n) AS last_id
            FROM r GROUP BY 1, 2),
        grp AS (SELECT grp, max(last_version) AS last FROM pages GROUP BY 1),
        cur AS (SELECT grp, coalesce(lag(last) OVER (ORDER BY grp), {s.DEFAULT_START}) AS cursor FROM grp),
        base AS (SELECT cursor, min(grp) AS b FROM cur GROUP BY 1)
        SELECT page_no, cur.cursor, (page_no - b * 20) * 500 AS "offset", records, first_version,
            last_version, last_id
        FROM pages JOIN cur USING (grp) JOIN base ON base.cursor = cur.cursor""",
)
def page_bounds(spark, sf_dir):
    paged = paging.assign_pages(d.activities(spark, sf_dir).select("id", "updated_at"), d.ACTIVITY)
    return paging.page_bounds(paged, d.ACTIVITY, s.DEFAULT_START)


@query(
    "page_stats", "activities",
    sql="""SELECT id // 500 AS page, count(*) AS records, min(updated_at) AS first_version,
        max(updated_at) AS last_version, arg_max(id, updated_at * 1000000000 + id) AS last_id
        FROM activities GROUP BY 1""",
)
def page_stats(spark, sf_dir):
    paged = d.activities(spark, sf_dir).withColumn("page", F.floor(F.col("id") / 500).cast("long"))
    return paging.page_stats(paged, "updated_at", "id", "page")


@query(
    "extract_page", "activities",
    sql=f"""SELECT id, "user", name, updated_at, score, {MARKS} FROM activities
        WHERE updated_at >= 1704844800 AND name = 'purchase'
        ORDER BY updated_at, id LIMIT 900 OFFSET 100""",
)
def extract_page(spark, sf_dir):
    source = d.activities(spark, sf_dir).withColumn("note", F.lit(None).cast("string"))
    page = paging.extract(
        source, d.ACTIVITY, since=1704844800, filters=F.col("name") == "purchase", limit=900, offset=100
    )
    return marks_text(page.drop("note"))


@query(
    "keyset_page", "activities",
    sql="""SELECT id, updated_at, name FROM activities
        WHERE updated_at > 1704844800 OR (updated_at = 1704844800 AND id > 0)
        ORDER BY updated_at, id LIMIT 500""",
)
def keyset_page(spark, sf_dir):
    rows = d.activities(spark, sf_dir).select("id", "updated_at", "name")
    return paging.keyset_page(rows, d.ACTIVITY, 1704844800, 0, 500)


@query(
    "missing_batches", "activities",
    sql="""SELECT DISTINCT 'activities/year=2026/month=09/day=08/' || "user" || '_1.json' AS path FROM activities""",
)
def missing_batches(spark, sf_dir):
    root = scratch(spark, "raw")
    source = d.activities(spark, sf_dir)
    pages = land_pages(source, d.BULK, root, NOW, s.DEFAULT_START)
    path = lambda a, b: F.format_string("activities/year=2026/month=09/day=08/%d_%d.json", a, b)
    logged = pages.select(path(F.col("cursor"), F.col("offset")).alias("path")).union(
        source.select(path(F.col("user"), F.lit(1))).distinct()
    )
    return missing_pages(logged, list_pages(spark, root))


# -- alignment and hash ------------------------------------------------------------


@query(
    "schema_align", "activities",
    sql=f"""SELECT id, "user", name, updated_at, score, CAST(NULL AS VARCHAR) AS note, {MARKS} FROM activities""",
)
def schema_align(spark, sf_dir):
    loose = d.activities(spark, sf_dir).select(
        F.col("id").cast("double").cast("string").alias("id"),
        F.col("user").cast("string").alias("user"),
        "name",
        F.col("updated_at").cast("double").alias("updated_at"),
        F.col("score").cast("string").alias("score"),
        F.to_json("marks").alias("marks"),
        "undeclared",
    )
    return marks_text(align(loose, d.ACTIVITY.schema))


@query(
    "row_hash",
    sql="""SELECT doc_id, sha256(concat_ws('|', CAST(doc_id AS VARCHAR), coalesce(text, ''),
        coalesce(nullif(lang, 'fr'), ''), coalesce(source, ''), coalesce(CAST(n_chars AS VARCHAR), '')))
        AS _hash FROM documents""",
)
def document_hash(spark, sf_dir):
    documents = d.table(spark, sf_dir, "documents").withColumn("lang", F.nullif("lang", F.lit("fr")))
    return documents.select("doc_id", row_hash(documents.schema).alias("_hash"))


@query(
    "row_hash_list", "games",
    sql="""SELECT id, sha256(CAST(id AS VARCHAR) || '|' || name || '|' || updated_at || '|'
        || coalesce(CAST(rating AS VARCHAR), '') || '|'
        || coalesce(array_to_string(list_sort(list_transform(list_filter(genres, lambda x: x IS NOT NULL),
            lambda x: CAST(x AS VARCHAR))), ','), '') || '|'
        || coalesce(array_to_string(list_sort(list_transform(platforms, lambda x: CAST(x AS VARCHAR))), ','), ''))
        AS _hash FROM games""",
)
def list_hash(spark, sf_dir):
    rows = align(d.games(spark, sf_dir), d.BUNDLE.schema)
    return stamp(rows, d.BUNDLE.schema, NOW).select("id", "_hash")


@query(
    "main_projection", "games", sql="SELECT id, name, updated_at, rating FROM games"
)
def scalar_columns(spark, sf_dir):
    return main_projection(align(d.games(spark, sf_dir), d.BUNDLE.schema), d.BUNDLE)


@query(
    "union_diagonal",
    sql="""SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
        UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part""",
)
def diagonal(spark, sf_dir):
    schema = s.record(
        *s.named(s.LONG, "id"), *s.named(s.TEXT, "name"), *s.named(s.REAL, "balance"), *s.named(s.TEXT, "segment")
    )
    pick = lambda source, **columns: d.table(spark, sf_dir, source).select(
        *[F.col(c).alias(n) for n, c in columns.items()]
    )
    supplier = pick("supplier", id="s_suppkey", name="s_name", balance="s_acctbal")
    return union_diagonal(
        [
            pick("customer", id="c_custkey", name="c_name", balance="c_acctbal", segment="c_mktsegment"),
            supplier.withColumn("id", F.col("id").cast("string")),
            pick("part", id="p_partkey", name="p_name"),
        ],
        schema,
    )


# -- dedup -------------------------------------------------------------------------


@query(
    "dedup_latest", "users",
    sql="""WITH twice AS (SELECT *, CAST(0 AS BIGINT) AS "again" FROM users UNION ALL SELECT *, 1 FROM users WHERE name = 'click'),
        r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, event_id DESC, "again" DESC) AS n
            FROM twice)
        SELECT id, name, updated_at, event_id, score, "again" FROM r WHERE n = 1""",
)
def dedup_latest(spark, sf_dir):
    once = d.users(spark, sf_dir).drop("marks").withColumn("again", F.lit(0).cast("long"))
    twice = once.where(F.col("name") == "click").withColumn("again", F.lit(1).cast("long"))
    return dedup_records(once.unionByName(twice), arrival=("event_id", "again"))


@query(
    "dedup_hot_key", "users",
    sql="""SELECT id, arg_max(event_id, updated_at * 1000000000 + event_id) AS event_id FROM
        (SELECT CASE WHEN score > 20 THEN 0 ELSE id END AS id, updated_at, event_id FROM users) GROUP BY 1""",
)
def dedup_hot_key(spark, sf_dir):
    hot = d.users(spark, sf_dir).select(
        F.when(F.col("score") > 20, 0).otherwise(F.col("id")).alias("id"), "updated_at", "event_id"
    )
    return dedup_records(hot, arrival=("event_id",)).select("id", "event_id")


# -- quality -----------------------------------------------------------------------


@query(
    "dq_required_fields", "games",
    sql="SELECT id, name FROM games WHERE id IS NULL OR first_release_date IS NULL",
)
def required_fields(spark, sf_dir):
    return valid_records(d.games(spark, sf_dir), "id", "first_release_date")[1].select("id", "name")


@query(
    "dq_null_keys", "games",
    sql="SELECT count(*) AS rows, count(*) FILTER (WHERE hypes IS NULL) AS null_keys FROM games",
)
def null_keys(spark, sf_dir):
    return quality.null_keys(d.games(spark, sf_dir), "hypes")


@query(
    "dq_required_nulls", "games",
    sql="""SELECT 'id' AS field, count(*) FILTER (WHERE id IS NULL) AS nulls FROM games
        UNION ALL SELECT 'rating', count(*) FILTER (WHERE rating IS NULL) FROM games
        UNION ALL SELECT 'genres', count(*) FILTER (WHERE genres IS NULL) FROM games""",
)
def required_nulls(spark, sf_dir):
    return quality.required_nulls(d.games(spark, sf_dir), ["id", "rating", "genres"])


@query(
    "dq_duplicate_keys",
    sql="""SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(d.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_scd2", "users",
    sql="""WITH s AS (SELECT id, updated_at // 3600 AS start, count(*) AS n,
            count(*) FILTER (WHERE name = 'signup') AS c FROM users GROUP BY 1, 2)
        SELECT id, CAST(sum(c) AS BIGINT) AS current_rows, count(*) FILTER (WHERE n > 1) AS repeated_starts
        FROM s GROUP BY 1 HAVING sum(c) <> 1 OR count(*) FILTER (WHERE n > 1) > 0""",
)
def history_violations(spark, sf_dir):
    naive = d.users(spark, sf_dir).select(
        "id",
        F.floor(F.col("updated_at") / 3600).alias("_valid_from"),
        (F.col("name") == "signup").alias("_is_current"),
    )
    return quality.history_violations(naive)


@query(
    "dq_orphans",
    sql="""SELECT doc_id AS key, count(*) AS rows FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""",
)
def orphans(spark, sf_dir):
    return quality.orphans(
        d.table(spark, sf_dir, "documents"), "doc_id", d.table(spark, sf_dir, "labels"), "doc_id"
    )


# -- merges ------------------------------------------------------------------------


def customers(spark, sf_dir):
    """Stored customers (one segment is not loaded yet) and staged ones (those with a final order)."""
    customer = d.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    spent = (
        d.table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("spent"))
    )
    staging = customer.join(spent, "c_custkey").select(
        "c_custkey", "c_name", F.col("spent").alias("c_acctbal"), "c_mktsegment"
    )
    return customer.where(F.col("c_mktsegment") != "BUILDING"), staging


CUSTOMERS = """WITH target AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'),
    staging AS (SELECT c_custkey, c_name, spent AS c_acctbal, c_mktsegment FROM customer JOIN
        (SELECT o_custkey, max(o_totalprice) AS spent FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o
        ON o_custkey = c_custkey)"""


@query(
    "upsert_update",
    sql=f"""{CUSTOMERS} SELECT c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
        coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment
        FROM target t FULL JOIN staging s USING (c_custkey)""",
)
def upsert_update(spark, sf_dir):
    target, staging = customers(spark, sf_dir)
    return merge.upsert(target, staging, ["c_custkey"])


@query(
    "upsert_newer",
    sql=f"""{CUSTOMERS} SELECT c_custkey, CASE WHEN t.c_acctbal > s.c_acctbal THEN t.c_acctbal
        ELSE coalesce(s.c_acctbal, t.c_acctbal) END AS c_acctbal
        FROM target t FULL JOIN staging s USING (c_custkey)""",
)
def upsert_newer(spark, sf_dir):
    target, staging = customers(spark, sf_dir)
    pick = ["c_custkey", "c_acctbal"]
    return merge.upsert(target.select(*pick), staging.select(*pick), ["c_custkey"], "c_acctbal")


@query(
    "upsert_ignore",
    sql="""WITH target AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A')
        SELECT l_orderkey, l_suppkey FROM target
        UNION ALL SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem
        WHERE (l_orderkey, l_suppkey) NOT IN (SELECT (l_orderkey, l_suppkey) FROM target)""",
)
def upsert_ignore(spark, sf_dir):
    lines = d.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_suppkey"]
    target = lines.where(F.col("l_returnflag") == "A").select(*keys).distinct()
    return target.unionByName(merge.insert_absent(target, lines.select(*keys).distinct(), keys))


@query(
    "upsert_partial",
    sql=f"""{CUSTOMERS} SELECT c_custkey, CASE WHEN t.c_custkey IS NULL THEN 'unknown' ELSE t.c_name END AS c_name,
        coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal, t.c_mktsegment
        FROM target t FULL JOIN staging s USING (c_custkey)""",
)
def upsert_partial(spark, sf_dir):
    target, staging = customers(spark, sf_dir)
    return merge.patch_columns(target, staging, ["c_custkey"], ["c_acctbal"], {"c_name": F.lit("unknown")})


def nation_store(spark, label):
    schema = s.record(*s.named(s.LONG, "key"), *s.named(s.TEXT, "name"))
    return TableStore(spark, scratch(spark, label)), s.TableSpec("members", schema, ("key",))


def members(spark, sf_dir, name, key, label):
    return d.table(spark, sf_dir, name).select(F.col(key).cast("long").alias("key"), F.col(label).alias("name"))


@query("full_replace", sql="SELECT s_suppkey AS key, s_name AS name FROM supplier")
def full_replace(spark, sf_dir):
    store, table = nation_store(spark, "replace")
    store.write(table, members(spark, sf_dir, "customer", "c_custkey", "c_name"), "replace")
    store.write(table, members(spark, sf_dir, "supplier", "s_suppkey", "s_name"), "replace")
    return store.read(table)


@query("table_scan", sql="SELECT c_custkey AS key, c_name AS name FROM customer")
def table_scan(spark, sf_dir):
    store, table = nation_store(spark, "scan")
    store.write(table, members(spark, sf_dir, "customer", "c_custkey", "c_name"), "fail")
    return store.read(table)


@query(
    "log_append",
    sql="SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def log_append(spark, sf_dir):
    store, table = nation_store(spark, "append")
    store.write(table, members(spark, sf_dir, "customer", "c_custkey", "c_name"))
    store.write(table, members(spark, sf_dir, "supplier", "s_suppkey", "s_name"))
    return store.read(table)


@query(
    "load_table", "activities",
    sql="""SELECT id, "user", name, updated_at, CASE WHEN name = 'click' THEN score * 2 ELSE score END AS score,
        sha256(concat_ws('|', CAST(id AS VARCHAR), CAST("user" AS VARCHAR), name, CAST(updated_at AS VARCHAR),
            CAST(CASE WHEN name = 'click' THEN score * 2 ELSE score END AS VARCHAR), '',
            coalesce(array_to_string(list_sort(list_transform(list_filter(marks, lambda x: x IS NOT NULL),
                lambda x: CAST(x AS VARCHAR))), ','), ''))) AS _hash,
        len(list_distinct(list_filter(marks, lambda x: x IS NOT NULL))) AS pairs FROM activities""",
)
def load(spark, sf_dir):
    store = TableStore(spark, scratch(spark, "load"))
    first = d.activities(spark, sf_dir)
    again = first.where(F.col("name") == "click").withColumn("score", F.col("score") * 2)
    load_table(store, d.ACTIVITY, first, NOW)
    load_table(store, d.ACTIVITY, again, NOW)
    junction = store.read(d.ACTIVITY.junction_table("marks"))
    pairs = junction.groupBy(F.col("activity_id").alias("id")).agg(F.count(F.lit(1)).alias("pairs"))
    main = store.read(d.ACTIVITY.main_table()).join(pairs, "id", "left")
    return main.select("id", "user", "name", "updated_at", "score", "_hash", F.coalesce("pairs", F.lit(0)).alias("pairs"))

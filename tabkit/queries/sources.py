"""Queries of the sources, sinks and schema operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators.ensemble import Stack, Voter
from tabkit.operators.regress import KernelRobust, Linear, tree
from tabkit.operators.roles import (
    enforce_types, infer_roles, role_report, schema_profile, select_by_type, set_roles, stored_roles,
)
from tabkit.operators.profile import value_counts
from tabkit.queries.obs import COLUMNS, FEATURES, KEY, ROLES, model_obs, obs, with_obs
from tabkit.queries.registry import query, rnd, table, work_folder
from tabkit.session import store
from tabkit.sources.dictionary import describe_columns, parse_dictionary, sections, text_lines
from tabkit.sources.store import load_models, save_models
from tabkit.sources.tables import (
    load_tables, read_splits, read_typed_csv, save_tables, stack_splits, write_predictions, write_typed_csv,
)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
BLOCK_ROWS = 2000


@query("a1_read_splits", with_obs("""SELECT split, id, priority, acctbal, price FROM obs"""))
def a1(spark, sf):
    folder = work_folder(spark)
    df = obs(spark, sf, ("id", "split", "priority", "acctbal", "price"))
    for name in ("train", "test"):
        part = df.filter(q("split") == name).drop("split")
        (part.drop("price") if name == "test" else part).write.option("header", True).option("nullValue", "NA").csv(f"{folder}/{name}")
    base = "id bigint, priority string, acctbal double"
    return read_splits(
        spark, {n: f"{folder}/{n}" for n in ("train", "test")}, {"train": base + ", price double", "test": base}
    )


@query("a2_stack_splits", """SELECT CASE WHEN o_orderkey%3=0 THEN 'test' ELSE 'train' END AS split, o_orderkey AS id,
 o_orderpriority AS priority, CASE WHEN o_orderkey%3=0 THEN NULL ELSE o_totalprice END AS price FROM orders""")
def a2(spark, sf):
    o = table(spark, sf, "orders").select(
        q("o_orderkey").alias("id"), q("o_orderpriority").alias("priority"), q("o_totalprice").alias("price"))
    return stack_splits({"train": o.filter("id % 3 <> 0"), "test": o.filter("id % 3 = 0").drop("price")})


@query("a3_read_typed_csv", "SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def a3(spark, sf):
    folder = work_folder(spark)
    write_typed_csv(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), folder)
    return read_typed_csv(spark, folder)


@query("a4_write_typed_csv", "SELECT CAST(count(*) AS BIGINT) AS n, count(DISTINCT l_returnflag) AS flags, round(sum(l_tax),4) AS tax "
       "FROM lineitem")
def a4(spark, sf):
    folder = work_folder(spark)
    write_typed_csv(table(spark, sf, "lineitem"), folder)
    return read_typed_csv(spark, folder).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("l_returnflag").alias("flags"), rnd(F.sum("l_tax"), 4).alias("tax"))


@query("a4_documents_round_trip", "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def a4_documents(spark, sf):
    """Texts with line breaks, quotes, backslashes and edge blanks come back as they were."""
    folder = work_folder(spark)
    write_typed_csv(table(spark, sf, "documents"), folder)
    return read_typed_csv(spark, folder)


@query("a4_orders_round_trip", "SELECT * FROM orders")
def a4_orders(spark, sf):
    """A date, decimal or other typed column comes back with its type."""
    folder = work_folder(spark)
    write_typed_csv(table(spark, sf, "orders"), folder)
    return read_typed_csv(spark, folder)


@query("a5_load_tables", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES))
def a5(spark, sf):
    out = None
    for name, df in load_tables(spark, sf, TABLES, view=False).items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("a6_save_tables", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, s_acctbal FROM customer "
       "LEFT JOIN supplier ON s_suppkey=c_custkey")
def a6(spark, sf):
    folder = work_folder(spark)
    save_tables({t: table(spark, sf, t) for t in ("customer", "supplier")}, folder)
    got = load_tables(spark, folder, ["customer", "supplier"], view=False)
    c, s = got["customer"], got["supplier"].select("s_suppkey", "s_acctbal")
    return c.join(s, c["c_custkey"] == s["s_suppkey"], "left").drop("s_suppkey")


@query("a7_parse_dictionary", """SELECT doc_id, pos, length(section) AS section_length, length(line) AS line_length FROM (
 SELECT doc_id, pos, line, last_value(CASE WHEN length(line)%5=0 THEN line END IGNORE NULLS)
   OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
 FROM (SELECT doc_id, CAST(u.pos-1 AS BIGINT) AS pos, u.line FROM documents,
   LATERAL (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)),1) AS pos) u))""")
def a7(spark, sf):
    lines = text_lines(table(spark, sf, "documents"), "doc_id", "text")
    marked = sections(lines, "doc_id", F.length("line") % 5 == 0, q("line"))
    return marked.select("doc_id", q("pos").cast("bigint").alias("pos"), F.length("section").cast("bigint").alias("section_length"),
                         F.length("line").cast("bigint").alias("line_length"))


@query("a7_dictionary_of_customers", """SELECT n_name AS var, 'customers of ' || n_name AS description, CAST(c_custkey AS VARCHAR) AS code, c_name AS label
 FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def a7_customers(spark, sf):
    """Texts of a nation and a block of its customers, a header and a line per customer, parsed back."""
    return parse_dictionary(customer_texts(spark, sf))


def customer_texts(spark, sf, block_rows: int = BLOCK_ROWS):
    """``path, value``: the number of blocks follows the row count, so that a text has about ``block_rows`` lines at most."""
    customers = table(spark, sf, "customer")
    blocks = -(-customers.count() // block_rows) or 1
    named = customers.join(table(spark, sf, "nation"), q("c_nationkey") == q("n_nationkey"))
    line = F.concat(F.lit("       "), q("c_custkey").cast("string"), F.lit("\t"), q("c_name"))
    block = F.pmod(F.xxhash64("c_custkey", "c_name"), F.lit(blocks))
    texts = named.groupBy("n_name", block.alias("block")).agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
    return texts.select(
        F.concat(q("n_name"), F.lit("/"), q("block").cast("string")).alias("path"),
        F.concat(q("n_name"), F.lit(": customers of "), q("n_name"), F.lit("\n\n"), q("lines"), F.lit("\n\t\n")).alias("value"))


@query("a8_describe_columns", with_obs("""
, d AS (SELECT 'status' AS "column", status AS code, lower(status) AS label FROM obs GROUP BY status
  UNION ALL SELECT 'segment', segment, lower(segment) FROM obs WHERE segment IS NOT NULL GROUP BY segment)
SELECT "column", 'levels of ' || "column" AS description, string_agg(code || '=' || label, ',' ORDER BY code) AS levels
FROM d GROUP BY "column" """))
def a8(spark, sf):
    df = obs(spark, sf, ("status", "segment", "month_sold"))
    dictionary = value_counts(df, ["status", "segment"]).select(
        q("column").alias("var"), F.concat(F.lit("levels of "), q("column")).alias("description"),
        q("value").alias("code"), F.lower("value").alias("label"))
    pairs = F.array_sort(F.map_entries("values"))
    return describe_columns(df, dictionary).select(
        "column", "description",
        F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("levels"))


def _roles_sql() -> str:
    kinds = [(c, k) for k in ("cat", "ord", "quant") for c in ROLES.of(k)]
    return with_obs(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS role, count({c}) AS non_null FROM obs" for c, k in kinds))


@query("a9_set_roles", _roles_sql())
def a9(spark, sf):
    tagged, _ = set_roles(obs(spark, sf), {k: ROLES.of(k) for k in ("cat", "ord", "quant")}, "price", KEY)
    kept = stored_roles(tagged.select("*"), "price", KEY)
    role = F.create_map(*[F.lit(x) for k in ("cat", "ord", "quant") for c in kept.of(k) for x in (c, k)])
    return schema_profile(tagged).select("column", role[q("column")].alias("role"), "non_null").filter("role is not null")


@query("a9_role_report", with_obs("""SELECT 'status' AS "column", 'has_role' AS rule, true AS ok, count(status) AS rows FROM obs
 UNION ALL SELECT 'nation', 'has_role', false, count(nation) FROM obs"""))
def a9_report(spark, sf):
    df = obs(spark, sf, ("id", "status", "nation"))
    counts = schema_profile(df).select("column", q("non_null").alias("rows"))
    return role_report(df, {"cat": ["status"]}, key=["id"]).filter("rule = 'has_role'").join(counts, "column")


@query("a10_select_by_type", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def a10(spark, sf):
    return select_by_type(table(spark, sf, "part"), "cat", key=["p_partkey"])


@query("a10_infer_roles", """SELECT 'p_name' AS "column", 'cat' AS role, count(p_name) AS n FROM part UNION ALL
 SELECT 'p_brand','cat',count(p_brand) FROM part UNION ALL SELECT 'p_type','cat',count(p_type) FROM part UNION ALL
 SELECT 'p_size','ord',count(p_size) FROM part UNION ALL SELECT 'p_retailprice','quant',count(p_retailprice) FROM part""")
def a10_infer(spark, sf):
    df = table(spark, sf, "part")
    kept = infer_roles(df, key=["p_partkey"])
    role = F.create_map(*[F.lit(x) for k in ("cat", "ord", "quant") for c in kept.of(k) for x in (c, k)])
    return schema_profile(df).select("column", role[q("column")].alias("role"), q("non_null").alias("n")).filter("role is not null")


@query("a11_enforce_types", """SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS BIGINT) AS p_retailprice
 FROM (SELECT p_partkey, p_size, floor(p_retailprice) AS p_retailprice FROM part)""")
def a11(spark, sf):
    from tabkit.operators.roles import Roles

    df = table(spark, sf, "part").select("p_partkey", "p_size", F.floor("p_retailprice").cast("double").alias("p_retailprice"))
    return enforce_types(df, Roles(cat=("p_size",), ord=("p_retailprice",), key=("p_partkey",)))


def _profile_sql() -> str:
    types = {**{c: "string" for c in ("split", "segment", "status", "nation", "priority", "sparse_note")},
             **{c: "bigint" for c in ("id", "month_sold", "year_sold", "n_lines", "n_ret")}}
    return with_obs(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{types.get(c, 'double')}' AS type, count({c}) AS non_null, count(*) AS row_count, "
        f"CAST({len(COLUMNS)} AS BIGINT) AS column_count FROM obs" for c in COLUMNS))


@query("a12_schema_profile", _profile_sql())
def a12(spark, sf):
    return schema_profile(obs(spark, sf))


@query("a13_write_predictions", "SELECT 'all' AS dataset, 'half' AS model, o_orderkey AS id, round(o_totalprice/2, 4) AS price FROM orders")
def a13(spark, sf):
    folder = work_folder(spark)
    preds = table(spark, sf, "orders").select(
        F.lit("all").alias("dataset"), F.lit("half").alias("model"), q("o_orderkey").alias("id"),
        (F.ln("o_totalprice") - F.ln(F.lit(2.0))).alias("p"))
    write_predictions(preds, folder, names=("id", "price"))
    got = spark.read.option("header", True).schema("id bigint, price double, dataset string, model string").csv(folder)
    return got.select("dataset", "model", "id", rnd("price", 4).alias("price"))


@query("a14_save_load_models", with_obs(""", m AS (SELECT id FROM obs WHERE split='train')
 SELECT count(*) AS n, 0.0::DOUBLE AS largest_difference FROM m"""))
def a14(spark, sf):
    folder = work_folder(spark)
    df = store(model_obs(spark, sf))
    fitted = Linear("ridge", {"alpha": 1.0}).fit(df, FEATURES, "y")
    save_models(spark, {"ridge": fitted}, folder)
    again = load_models(spark, folder)["ridge"]
    both = again.predict(fitted.predict(df, "a"), "b")
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(q("a") - q("b"))).alias("largest_difference"))


@query("a14_every_kind", with_obs("SELECT kind, count(*) AS n, 0.0::DOUBLE AS largest_difference FROM obs, "
                                  "(SELECT unnest(['kernel', 'stack', 'tree', 'voter']) AS kind) WHERE split='train' GROUP BY kind"))
def a14_kinds(spark, sf):
    """Models of Spark ML, of kernel features and ensembles of them predict the same after loading."""
    folder = work_folder(spark)
    df = store(model_obs(spark, sf))
    specs = {
        "tree": tree(3), "kernel": KernelRobust(width=8), "voter": Voter({"ridge": Linear("ridge"), "tree": tree(2)}),
        "stack": Stack({"ridge": Linear("ridge"), "tree": tree(2)}, Linear("ridge")),
    }
    fitted = {n: s.fit(df, FEATURES, "y") for n, s in specs.items()}
    save_models(spark, fitted, folder)
    out = None
    for n, again in load_models(spark, folder).items():
        both = again.predict(fitted[n].predict(df, "a"), "b")
        part = both.agg(F.lit(n).alias("kind"), F.count(F.lit(1)).alias("n"), F.max(F.abs(q("a") - q("b"))).alias("largest_difference"))
        out = part if out is None else out.unionByName(part)
    return out

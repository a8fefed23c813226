"""Edge rows and small closed-form cases."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tabkit.functions.expr import q
from tabkit.operators import encode, features, profile, roles, rows
from tabkit.operators.density import histogram
from tabkit.operators.depend import correlations, dependence_distance, kendall, rank_by, spearman
from tabkit.operators.impute import impute_few
from tabkit.operators.ordering import column_modes, column_quantiles, ordered_prefix, quantiles
from tabkit.operators.ranking import rank_datasets_within_model, rank_models_within_dataset
from tabkit.operators.evaluate import cv_rmse
from tabkit.operators.reshape import attach_columns
from tabkit.operators.sparse import fit_sparse, sparse_model_matrix, sparse_one_hot
from tabkit.operators.search import normalise_weights
from tabkit.sources.bucketed import bucket_count, correct_bucketed, join_bucketed, layout, write_bucketed
from tabkit.sources.dictionary import describe_columns, parse_dictionary, undocumented_levels
from tabkit.sources.tables import read_csv, read_splits, read_typed_csv, read_typed_file, write_typed_csv


def by_id(df, col):
    return {r["id"]: r[col] for r in df.select("id", col).collect()}


def test_null_in_a_predicate_keeps_the_row(edge):
    kept = rows.drop_matching(edge, [(q("q2") < 5) & (q("y") > 200)])
    assert set(by_id(kept, "cat")) == {1, 3, 5, 6}


def test_first_match_only(edge):
    kept = rows.drop_first_match(edge, [q("y") == 100, q("q2") > 100])
    assert set(by_id(kept, "cat")) == {2, 3, 4, 5, 6}


def test_sparse_columns(edge):
    kept = rows.drop_sparse_columns(edge, 0.20, keep=["y"])
    assert "allnull" not in kept.columns and "y" in kept.columns and "cat" in kept.columns


def test_log_variants(edge):
    zero = by_id(features.log_transform(edge, ["q1"], zero="zero"), "log_q1")
    assert zero[1] == 0.0 and zero[4] is None and zero[5] is None
    low = features.log_transform(edge.filter("q1 >= 0 or q1 is null"), ["q1"], zero="min")
    assert by_id(low, "log_q1")[1] == pytest.approx(math.log(0.5)) and "q1" not in low.columns


def test_round_half_to_even(edge):
    got = by_id(encode.round_numeric(edge, ["q1"]), "q1")
    assert got[2] == 0.0 and got[3] == 2.0 and got[6] == 4.0


def test_ratio_and_flags(edge):
    assert by_id(features.add_ratio(edge, "r", "q1", "q2"), "r")[2] is None
    flags = by_id(features.flag_nonzero(edge, "f", "q1"), "f")
    assert flags[1] == 0 and flags[5] == 1


def test_unmapped_level_raises(edge):
    codes = {"ord": {None: 0, "Po": 1, "TA": 2, "Gd": 3, "Ex": 4}}
    with pytest.raises(ValueError, match=r"\?\?"):
        encode.encode_ordinals(edge, codes)
    ok = encode.encode_ordinals(edge.filter("id < 6"), codes)
    assert by_id(ok, "ord") == {1: 3, 2: 0, 3: 2, 4: 1, 5: 4}


def test_constant_column_scales_to_zero(edge):
    scaled, params = encode.min_max_scale(edge, ["const", "q2", "allnull"])
    assert set(by_id(scaled, "const").values()) == {0.0}
    assert by_id(encode.inverse_scale(scaled, params), "q2") == by_id(edge, "q2")


def test_one_hot_keeps_the_text_none(edge):
    flags = encode.one_hot(edge, ["cat"])
    assert {"cat_A", "cat_B", "cat_None"} <= set(flags.columns)
    assert by_id(flags, "cat_None")[6] == 1 and by_id(flags, "cat_None")[5] == 0


def test_mode_ties_take_the_smallest(edge):
    assert column_modes(edge, ["cat"]) == {"cat": "A"}


def test_few_nulls(edge):
    r = roles.Roles(cat=("cat",), quant=("q1", "q2", "allnull"), response="y")
    got = impute_few(edge, r, max_cat=4, max_ord=2, max_quant=1)
    assert by_id(got, "cat")[5] == "A" and by_id(got, "q2")[3] == 6.0 and by_id(got, "allnull")[1] is None


def test_profile_of_nulls(edge):
    assert {r["column"]: r["nulls"] for r in profile.null_counts(edge).collect()} == {
        "cat": 1, "ord": 1, "q1": 1, "q2": 1, "allnull": 6, "y": 2}
    assert profile.columns_with_nulls(edge.select("id", "split")).columns == ["id", "split"]
    with pytest.raises(ValueError):
        profile.null_columns_by_role(edge, roles.Roles())


def test_constant_histogram(edge):
    got = histogram(edge, ["const"], 4).collect()
    assert len(got) == 1 and got[0]["bin"] == 0 and got[0]["n"] == 6


def test_roles_are_checked(edge):
    key = ["id", "split"]
    good = {"cat": ["cat", "gone"], "ord": ["ord"], "quant": ["q1", "q2", "const", "allnull", "y"]}
    tagged, kept = roles.set_roles(edge, good, "y", key)
    assert kept.cat == ("cat",)
    assert roles.stored_roles(tagged.select("cat", "q1")).quant == ("q1",)
    for bad in ({**good, "weird": []}, {**good, "cat": "cat"}, {**good, "cat": [1]}, {**good, "ord": []}):
        with pytest.raises(ValueError):
            roles.set_roles(edge, bad, "y", key)


def test_dictionary_text(spark):
    text = (
        "Alley: Type of alley access to property\n\n       Grvl\tGravel\n       NA \tNo alley access\n\t\t\n"
        "LotArea: Lot size in square feet\n\nHouseStyle: Style of dwelling\n\t\n"
        "       1.5Fin\tOne and one-half story: 2nd level finished\nBedroom: Bedrooms above grade\n     \n"
    )
    got = parse_dictionary(spark.createDataFrame([("f", text)], "path string, value string"))
    assert {(r["var"], r["code"], r["label"]) for r in got.collect()} == {
        ("Alley", "Grvl", "Gravel"), ("Alley", "NA", "No alley access"), ("LotArea", None, None),
        ("HouseStyle", "1.5Fin", "One and one-half story: 2nd level finished"), ("BedroomAbvGr", None, None)}
    shown = describe_columns(spark.createDataFrame([("x", 1)], "Alley string, LotArea int"), got).collect()
    assert {r["column"]: r["values"] for r in shown} == {
        "Alley": {"Grvl": "Gravel", "NA": "No alley access"}, "LotArea": {}}
    with pytest.raises(ValueError):
        describe_columns(got, None)
    counts = spark.createDataFrame([("Alley", "Grvl", 2), ("Alley", "Dirt", 1), ("Other", "x", 1)], "column string, value string, n bigint")
    assert [r["value"] for r in undocumented_levels(counts, got).collect()] == ["Dirt"]


def test_csv_nulls_and_splits(spark, tmp_path):
    (tmp_path / "train.csv").write_text("Id,A,Price\n1,None,10.5\n2,NA,\n3,,7\n")
    (tmp_path / "test.csv").write_text("Id,A\n4,x\n")
    schema = {"train": "Id bigint, A string, Price double", "test": "Id bigint, A string"}
    df = read_splits(spark, {n: str(tmp_path / f"{n}.csv") for n in ("train", "test")}, schema)
    assert {(r["split"], r["Id"], r["A"], r["Price"]) for r in df.collect()} == {
        ("train", 1, "None", 10.5), ("train", 2, None, None), ("train", 3, None, 7.0), ("test", 4, "x", None)}


def test_typed_csv_round_trip(edge, spark, tmp_path):
    path = str(tmp_path / "typed")
    write_typed_csv(edge, path)
    back = read_typed_csv(spark, path)
    assert back.dtypes == edge.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, edge.collect()))


def test_typed_file_with_a_type_row(spark, tmp_path):
    path = tmp_path / "clean.csv"
    path.write_text("split,Id,A,B\ntrain,0,object,float64\ntrain,1,x,2.5\ntest,2,NA,\n")
    df = read_typed_file(spark, str(path))
    assert {(r["Id"], r["A"], r["B"]) for r in df.collect()} == {("1", "x", 2.5), ("2", None, None)}


def test_comparison_table(spark):
    preds = spark.createDataFrame(
        [(d, m, f, 0.0, math.sqrt(e)) for d, m, es in (("d1", "m1", (0.01, 0.03)), ("d1", "m2", (0.04, 0.04)), ("d2", "m1", (0.09, 0.01)), ("d2", "m2", (0.01, 0.01)))
         for f, e in enumerate(es)], "dataset string, model string, fold int, y double, p double")
    got = cv_rmse(preds)
    assert {(r["dataset"], r["model"]): round(r["cv_rmse"], 6) for r in got.collect()} == {
        ("d1", "m1"): 0.141421, ("d1", "m2"): 0.2, ("d2", "m1"): 0.223607, ("d2", "m2"): 0.1}
    assert {(r["dataset"], r["model"]): r["rank"] for r in rank_models_within_dataset(got).collect()} == {
        ("d1", "m1"): 1, ("d1", "m2"): 2, ("d2", "m2"): 1, ("d2", "m1"): 2}
    assert {(r["dataset"], r["model"]): r["rank"] for r in rank_datasets_within_model(got).collect()} == {
        ("d1", "m1"): 1, ("d2", "m1"): 2, ("d2", "m2"): 1, ("d1", "m2"): 2}


def test_weights(spark):
    w = spark.createDataFrame([("e", "a", 2.0), ("e", "b", 1.0), ("e", "c", 1.0)], "ensemble string, model string, weight double")
    assert {r["model"]: r["weight"] for r in normalise_weights(w, ["ensemble"]).collect()} == {"a": 0.5, "b": 0.25, "c": 0.25}


@pytest.mark.parametrize("parts", [1, 7])
def test_ordered_prefix_with_a_hot_group(spark, parts):
    """A third of the rows in one group, groups spanning partitions, under any partition count."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(3000).select(
            F.when(q("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), q("id") % 50)).alias("g"), "id", (q("id") % 5).alias("w"))
        got = {r["id"]: r["before"] for r in ordered_prefix(df, ["g"], ["id"], "w").collect()}
        arrays = {r["id"]: r["before"] for r in ordered_prefix(df.withColumn("w", F.array(q("w"), F.lit(1).cast("bigint"))), ["g"], ["id"], "w").collect()}
        sums, counts = {}, {}
        for i in range(3000):
            g = "hot" if i % 3 == 0 else f"g{i % 50}"
            assert got[i] == sums.get(g, 0) and arrays[i] == [sums.get(g, 0), counts.get(g, 0)]
            sums[g] = sums.get(g, 0) + i % 5
            counts[g] = counts.get(g, 0) + 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_quantiles_are_exact_when_the_sketch_is_coarse(spark):
    df = spark.range(20000).select(F.lit("x").alias("column"), F.when(q("id") % 3 == 0, 7.0).otherwise((q("id") * 7919) % 20011 / 3.0).alias("value"))
    values = sorted(r["value"] for r in df.collect())

    def exact(p):
        at = (len(values) - 1) * p
        lo = values[int(at)]
        return lo + (values[min(int(at) + 1, len(values) - 1)] - lo) * (at - int(at))

    for accuracy in (10, 100, 1000):
        got = {r["prob"]: r["quantile"] for r in quantiles(df, ["column"], "value", [0.0, 0.1, 0.5, 0.77, 1.0], accuracy).collect()}
        assert got == {p: pytest.approx(exact(p)) for p in (0.0, 0.1, 0.5, 0.77, 1.0)}
    assert column_quantiles(df.select("value"), ["value"])["value"] == pytest.approx(exact(0.5))


def test_empty_tables(edge):
    none = edge.filter("id < 0")
    assert rows.drop_sparse_columns(none, 0.2).columns == edge.columns
    assert profile.null_counts(none).count() == 0 and profile.value_counts(none, ["cat", "ord"]).count() == 0
    assert column_quantiles(none, ["q1"]) == {} and column_modes(none, ["cat"]) == {}
    assert encode.min_max_scale(none, ["q1"])[0].count() == 0
    assert rows.drop_first_match(none, [q("y") > 0]).count() == 0
    assert rank_by(none, "q1", ["id"]).count() == 0
    assert encode.one_hot(none, ["cat"]).columns == [c for c in edge.columns if c != "cat"]


def test_statistics_of_constant_and_empty_columns(edge):
    pairs = {(r["var1"], r["var2"]): r["r"] for r in correlations(edge, ["q1", "q2", "const", "y"]).collect()}
    assert pairs["q1", "const"] is None and pairs["q1", "y"] is not None
    assert dependence_distance(edge, "const", "split").first()["D"] == pytest.approx(1.0)
    assert dependence_distance(edge.withColumn("c2", F.lit("x")), "const", "c2").first()["D"] is None
    tests = {r["variable"]: r["stat"] for r in spearman(edge, ["q1", "const", "allnull"], "y").collect()}
    assert tests["const"] is None and "allnull" not in tests and tests["q1"] is not None
    taus = {r["variable"]: r["stat"] for r in kendall(edge, ["q1", "const"], "y").collect()}
    assert taus["const"] is None and taus["q1"] == pytest.approx(-3 / (6 * 5) ** 0.5)


def test_correlations_alike_on_both_paths(spark, monkeypatch):
    """NaN is missing and a constant column has no correlation, however many columns there are."""
    from tabkit.operators import depend

    nan = float("nan")
    rows = [(1.0, 2.0, 5.0, 0.1, None), (2.0, nan, 5.0, 0.1, 1.0), (3.0, 7.0, 5.0, 0.1, 2.0), (4.0, 7.5, 5.0, 0.1, nan), (None, 1.0, 5.0, 0.1, 4.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    few = {(r.var1, r.var2): r.r for r in depend.correlations(df, df.columns).collect()}
    monkeypatch.setattr(depend, "CHUNK", 0)
    many = {(r.var1, r.var2): r.r for r in depend.correlations(df, df.columns).collect()}
    assert few.keys() == many.keys()
    for k, v in few.items():
        assert (v is None) == (many[k] is None) and (v is None or abs(v - many[k]) < 1e-12)
    assert few["a", "c"] is None and few["c", "d"] is None and few["a", "b"] is not None


def test_single_column_has_its_diagonal(edge):
    from tabkit.operators.depend import dependence_matrix

    assert [tuple(r) for r in dependence_matrix(edge, ["cat"]).collect()] == [("cat", "cat", 0.0)]


def test_donors_need_a_prediction(spark):
    from tabkit.operators.impute import impute_chained, match_donors

    donors = spark.createDataFrame([(1, None, 9.0), (2, 1.0, 1.0), (3, 1.1, 2.0), (4, 5.0, 3.0)], "id bigint, pred double, value double")
    asked = spark.createDataFrame([(7, 1.0), (8, None)], "id bigint, pred double")
    assert [(r["id"], r["_drawn"]) for r in match_donors(donors, asked, "id", 1, lambda c: F.lit(0)).collect()] == [(7, 1.0)]
    holes = spark.createDataFrame([(1, None, 1.0), (2, 2.0, None), (3, 3.0, 4.0)], "id bigint, y double, x double")
    with pytest.raises(ValueError, match="x"):
        impute_chained(holes, "id", ["y"], ["x"], iterations=1)


def test_typed_csv_keeps_texts_and_types(spark, tmp_path):
    import datetime
    import decimal

    from tabkit.sources.tables import read_typed_csv, write_typed_csv

    rows = [
        (1, "line one\nline two", datetime.date(2020, 1, 2), decimal.Decimal("1.50"), 0.5), (2, " pad ", None, None, None),
        (3, 'a "quoted", \\ back\\"slash', datetime.date(1999, 12, 31), decimal.Decimal("-2.25"), 2.0), (4, "\ttab\r", None, None, 1.0),
    ]
    df = spark.createDataFrame(rows, "id bigint, text string, day date, sum decimal(9,2), f float")
    write_typed_csv(df, f"{tmp_path}/t")
    back = read_typed_csv(spark, f"{tmp_path}/t")
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == rows
    with pytest.raises(TypeError, match="tags"):
        write_typed_csv(spark.createDataFrame([([1],)], "tags array<int>"), f"{tmp_path}/u")


def test_unmapped_values_are_counted_and_ordered(spark):
    from tabkit.operators.encode import encode_ordinals

    df = spark.createDataFrame([(f"v{i:03d}",) for i in range(30)], "o string")
    with pytest.raises(ValueError, match=r"30 values without a code.*o='v000', o='v001'"):
        encode_ordinals(df, {"o": {"x": 1}})


def test_epsilon_is_not_changed():
    from tabkit.operators.regress import KernelRobust

    with pytest.raises(ValueError):
        KernelRobust(epsilon=0.5)


def test_sizes_count_what_arrays_hold(spark):
    from tabkit.session import fits_broadcast

    df = spark.createDataFrame([(["x" * 1000] * 3,)], "a array<string>").withColumn("s", F.array(F.struct(F.col("a")[0].alias("t"))))
    assert not fits_broadcast(df, 3900) and fits_broadcast(df, 5000)


def test_customer_texts_stay_short_in_a_hot_nation(spark, tmp_path):
    from tabkit.queries.sources import customer_texts

    spark.range(1, 1001).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"), F.lit(1).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, "X")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    texts = customer_texts(spark, str(tmp_path), 50).collect()
    assert len({t.path for t in texts}) == len(texts) == 20 and max(t.value.count("\tc") for t in texts) < 100
    got = parse_dictionary(customer_texts(spark, str(tmp_path), 50)).collect()
    assert sorted((r["var"], r["description"], int(r["code"]), r["label"]) for r in got) == [("X", "customers of X", i, f"c{i}") for i in range(1, 1001)]


def test_sparse_flags_equal_the_wide_form(edge):
    """Nulls and levels that the fit did not see have no flag; the text ``None`` is a level."""
    wide = encode.one_hot(edge.select("id", "cat", "ord"), ["cat", "ord"])
    made, names = sparse_one_hot(edge.select("id", "cat", "ord"), ["cat", "ord"])
    order = [f"{r['column']}_{r['value']}" for r in names.orderBy("slot").collect()]
    assert order == [c for c in wide.columns if c != "id"]
    expected = {r["id"]: [r[c] for c in order] for r in wide.collect()}
    assert {r["id"]: list(r["features"].toArray()) for r in made.collect()} == expected
    train = fit_sparse(edge.filter("split = 'train'"), ["cat"])
    assert [r["features"].numNonzeros() for r in train.apply(edge.select("id", "cat")).orderBy("id").collect()] == [1, 1, 1, 1, 0, 0]


def test_sparse_matrix_keeps_zeros(edge):
    some = roles.Roles(cat=("cat",), quant=("q1", "q2", "const", "allnull"), response="y", key=("id",))
    made, names = sparse_model_matrix(edge, some, "y")
    at = {r["column"]: r["slot"] for r in names.filter("value is null").collect()}
    rows_ = {r["id"]: r["features"] for r in made.collect()}
    assert made.columns == ["id", "features", "y"] and rows_[1].size == 4 + 3
    assert rows_[1][at["q1"]] == 0.0 and rows_[6][at["q1"]] == 1.0 and rows_[4][at["q1"]] == pytest.approx(-1 / 3.5)
    assert rows_[2][at["const"]] == 1.0 and math.isnan(rows_[5][at["q1"]]) and math.isnan(rows_[1][at["allnull"]])
    assert fit_sparse(edge, [], ["q1"]).apply(edge.select("id", "q1")).count() == 6
    nothing = fit_sparse(edge.filter("false"), ["cat"], ["q2"])
    assert nothing.width == 1 and nothing.apply(edge.select("id", "cat", "q2")).count() == 6


def test_sparse_flags_of_many_levels(spark):
    """50,000 levels: the plan has a handful of columns, each row two flags."""
    df = spark.range(60000).selectExpr("id", "concat('v', id % 50000) AS a", "id % 7 AS `b.c`", "id AS column")
    made, names = sparse_one_hot(df, ["a", "b.c"])
    assert names.count() == 50007 and made.columns == ["id", "column", "features"]
    got = made.filter("id = 50003").first()["features"]
    assert got.size == 50007 and len(got.indices) == 2
    named = {r["slot"]: (r["column"], r["value"]) for r in names.filter(F.col("slot").isin([int(i) for i in got.indices])).collect()}
    assert sorted(named.values()) == [("a", "v3"), ("b.c", str(50003 % 7))]
    assert made.count() == 60000


@pytest.fixture()
def bucketed(edge, spark, tmp_path):
    names = ["bucketed_rows", "bucketed_more", "bucketed_other"]
    write_bucketed(edge, names[0], ["split", "id"], 4, str(tmp_path / "a"))
    write_bucketed(edge.filter("id <> 3").withColumn("twice", q("q1") * 2), names[1], ["split", "id"], 4, str(tmp_path / "b"))
    write_bucketed(edge, names[2], ["id"], 4, str(tmp_path / "c"))
    yield names
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_bucketed_join_has_no_exchange(bucketed, edge, spark):
    rows_, more, other = bucketed
    joined = join_bucketed(spark, {rows_: None, more: ["twice"]}, ["split", "id"])
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    expected = attach_columns(edge, edge.filter("id <> 3").withColumn("twice", q("q1") * 2), ["twice"], ["split", "id"])
    assert sorted(map(str, joined.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert layout(spark, rows_) == (4, ("split", "id"))
    with pytest.raises(ValueError, match="laid out"):
        join_bucketed(spark, {rows_: None, other: None}, ["split", "id"])
    with pytest.raises(ValueError, match="bucketed by"):
        join_bucketed(spark, {other: None, rows_: None}, ["split", "id"])


def test_bucketed_corrections(bucketed, spark):
    fixes = spark.createDataFrame([("train", 1, 7.0), ("test", 6, None), ("test", 1, 8.0)], "split string, id bigint, new double")
    got = {r["id"]: r["q1"] for r in correct_bucketed(spark, bucketed[0], fixes, ["split", "id"], "q1", "new").collect()}
    assert got == {1: 7.0, 2: 0.5, 3: 2.5, 4: -1.0, 5: None, 6: None}


def test_bucket_counts():
    assert [bucket_count(b, 100) for b in (0, 100, 101, 450)] == [1, 1, 2, 8]

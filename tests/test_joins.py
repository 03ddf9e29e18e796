
from tessera.operators import joins
from tessera.operators import text as tops


def test_role_join_two_roles_and_missing_dimension(spark):
    fact = spark.createDataFrame([(1, "A", "B"), (2, "A", "Z")], "id INT, origin STRING, dest STRING")
    dim = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "code STRING, lat DOUBLE")
    x = joins.role_join(fact, dim, "origin", "code", "orig_")
    x = joins.role_join(x, dim, "dest", "code", "dest_")
    got = {r["id"]: (r["orig_lat"], r["dest_lat"]) for r in x.collect()}
    assert got == {1: (1.0, 2.0), 2: (1.0, None)}          # missing dimension row -> NULL, row kept


def test_orphans_and_duplicate_keys(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk INT")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "id INT, fk INT")
    assert [r["id"] for r in joins.orphans(child, parent, "fk", "pk").collect()] == [11]   # NULL FK is not an orphan
    assert [(r["pk"], r["n_rows"]) for r in joins.duplicate_keys(parent, ["pk"]).collect()] == [(2, 2)]


def test_word_frequency_skips_top_three(spark):
    df = spark.createDataFrame([(["a"] * 5 + ["b"] * 4 + ["c"] * 3 + ["d"] * 2 + ["e"],)], "tokens ARRAY<STRING>")
    got = [(r["token"], r["rank"]) for r in tops.word_frequency(df, "tokens", top_k=5, skip=3).orderBy("rank").collect()]
    assert got == [("d", 4), ("e", 5)]

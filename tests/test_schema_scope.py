"""Schema evolution over generated pairs of types, and exclusion of columns and tables."""

import itertools

import pytest
from pyspark.sql.types import StructType

from tidemark.functions import scope
from tidemark.operators.schema import align, apply_changes, can_cast, can_widen, mirror_evolution, plan_evolution, widest

pytestmark = pytest.mark.usefixtures("spark")  # types are parsed by its session
SCALES = [f"decimal({p},{s})" for p, s in itertools.product((5, 9, 18, 38), (0, 1, 3))]
TYPES = ["boolean", "tinyint", "int", "bigint", "float", "double", "date", "timestamp", "string", "binary", "array<int>", "map<string,int>", "struct<p:double,q:array<binary>>", "struct<p:double>", *SCALES]


def schema(text: str) -> StructType:
    return StructType.fromDDL(text)


def wider(old: str, new: str) -> bool:
    """The rule in words: int to long, float to double, a decimal to more digits at one scale."""
    if {old, new} <= set(SCALES):
        (p, s), (q, t) = (map(int, x[8:-1].split(",")) for x in (old, new))
        return s == t and q > p
    return (old, new) in {("int", "bigint"), ("float", "double")}


@pytest.mark.parametrize("old", TYPES)
def test_every_pair_of_types(old):
    for new in TYPES:
        a, b = schema(f"k bigint, v {old}"), schema(f"k bigint, v {new}")
        assert can_widen(a["v"].dataType, b["v"].dataType) == wider(old, new)
        assert can_cast(b["v"].dataType, a["v"].dataType) == (old == new or wider(new, old))
        if old == new or wider(new, old):
            assert plan_evolution(a, b) == ([], a)
        elif wider(old, new):
            changes, after = plan_evolution(a, b)
            assert [(c.kind, c.column, c.type) for c in changes] == [("WIDEN", "v", b["v"].dataType)] and after == b
        else:
            with pytest.raises(TypeError, match="column v: .* does not fit"):
                plan_evolution(a, b)


@pytest.mark.parametrize("n", range(5))
def test_columns_come_and_stay(n):
    """Any columns may be missing from a source, and any new ones are added at the end, in its order."""
    names = [f"c{k}" for k in range(5)]
    for held in itertools.combinations(names, n):
        for given in itertools.combinations(names[::-1], 3):
            changes, after = plan_evolution(schema(", ".join(f"{c} int" for c in held) or "z int"), schema(", ".join(f"{c} int" for c in given)))
            new = [c for c in given if c not in held]
            assert [(c.kind, c.column) for c in changes] == [("ADD", c) for c in new]
            assert after.fieldNames() == [*(held or ("z",)), *new] and all(after[c].nullable for c in new)


def test_names_match_by_case_and_structs_whole():
    changes, after = plan_evolution(schema("Total int"), schema("total int"))
    assert [c.column for c in changes] == ["total"] and after.fieldNames() == ["Total", "total"]
    with pytest.raises(TypeError, match="column s"):
        plan_evolution(schema("s struct<p:int>"), schema("s struct<p:bigint>"))


def test_mirror_and_widest():
    changes, _ = mirror_evolution(schema("id long"), schema("load_ts timestamp, id long, a int, fingerprint string"))
    assert [c.column for c in changes] == ["a"]
    for order in itertools.permutations(["x int", "x bigint, y float", "x int, y double, z string"]):
        assert {f.name: f.dataType.simpleString() for f in widest([schema(s) for s in order])} == {"x": "bigint", "y": "double", "z": "string"}


def test_align(spark):
    df = spark.createDataFrame([(1, 2.5)], "b int, a float")
    out = align(df, schema("a double, b long, c string"))
    assert out.dtypes == [("a", "double"), ("b", "bigint"), ("c", "string")]
    assert tuple(out.first()) == (2.5, 1, None)


def test_column_exclusion(spark):
    e = scope.ColumnExclusion(" Salary , Staff:Email,staff: iban ,")
    assert e.columns_for("STAFF") == {"salary", "email", "iban"} and e.columns_for("x") == {"salary"}
    assert scope.ColumnExclusion(None).columns_for("x") == scope.ColumnExclusion(" , ").columns_for("x") == set()
    assert e.apply(spark.createDataFrame([(1, 2, 3)], "id int, SALARY int, email int"), "other").columns == ["id", "email"]
    for table, column in itertools.product(("", "any:"), ("id", "OP", " seqval_hex ")):
        with pytest.raises(ValueError, match="protected"):
            scope.ColumnExclusion(f"fine, {table}{column}")
    for bad in ("p:q:r", ":column", "table:", ":", "a,b:,c"):
        with pytest.raises(ValueError, match="malformed"):
            scope.ColumnExclusion(bad)


def test_exclude_tables_and_view(spark):
    df = spark.createDataFrame([("A",), ("b",), (" C",)], "table_name string")
    assert {r[0] for r in scope.exclude_tables(df, "a , c,").collect()} == {"b"}
    assert scope.exclude_tables(df, "").count() == 3
    scope.restricted_view(spark.createDataFrame([(1, 2)], "x int, y int"), ["y"], "seen")
    assert spark.table("seen").columns == ["y"]


def test_apply_changes(spark):
    spark.sql("CREATE TABLE evolving (id long) USING parquet")
    try:
        changes, after = plan_evolution(spark.table("evolving").schema, schema("id long, note string"))
        apply_changes(spark, "evolving", changes)
        assert spark.table("evolving").schema.simpleString() == after.simpleString()
    finally:
        spark.sql("DROP TABLE evolving")


def test_widening_statement(monkeypatch):
    """The statement for a format that can widen; none is at hand to run it."""
    sent = []
    changes, _ = plan_evolution(schema("`a b` int, d decimal(5,1)"), schema("`a b` bigint, d decimal(9,1)"))
    apply_changes(type("Session", (), {"sql": staticmethod(sent.append)}), "db.t", changes)
    assert sent == ["ALTER TABLE `db`.`t` ALTER COLUMN `a b` TYPE bigint", "ALTER TABLE `db`.`t` ALTER COLUMN `d` TYPE decimal(9,1)"]

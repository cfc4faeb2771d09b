"""Fingerprints, differences and classification of schemas, all cases in a few jobs."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floodmark.functions import classify
from floodmark.operators import registry
from floodmark.operators.keyed import KEY_HASH
from floodmark.workload import schemas

ID = ("id", "INTEGER", "REQUIRED", [])


def leaf(name, dtype="STRING", mode="NULLABLE"):
    return (name, dtype, mode, [])


def rows(table, fields, parent="", depth=0, description=""):
    for name, dtype, mode, children in fields:
        path = f"{parent}.{name}" if parent else name
        yield ("d", table, 1, path, parent, name, dtype, mode, description, depth)
        yield from rows(table, children, path, depth + 1, description)


ADDRESS = [leaf("street"), leaf("city")]
CASES = {
    # name: (old, new, change type, [(change, path)])
    "same": ([ID, leaf("name")], [ID, leaf("name")], "NONE", []),
    "permuted": ([leaf("b"), leaf("a")], [leaf("a"), leaf("b")], "NONE", []),
    "add_nullable": ([ID], [ID, leaf("email")], "ADDITIVE", [("ADD", "email")]),
    "add_repeated": ([ID], [ID, leaf("tags", mode="REPEATED")], "ADDITIVE", [("ADD", "tags")]),
    "add_required": ([ID], [ID, leaf("email", mode="REQUIRED")], "BREAKING", [("ADD", "email")]),
    "add_empty_mode": ([ID], [ID, leaf("email", mode="")], "ADDITIVE", [("ADD", "email")]),
    "drop": ([ID, leaf("name")], [ID], "BREAKING", [("DROP", "name")]),
    "retype": ([ID], [("id", "STRING", "REQUIRED", [])], "BREAKING", [("TYPE_CHANGE", "id")]),
    "widen": ([leaf("v", "INT64")], [leaf("v", "FLOAT64")], "ADDITIVE", [("TYPE_CHANGE", "v")]),
    "narrow": ([leaf("v", "STRING")], [leaf("v", "INT64")], "BREAKING", [("TYPE_CHANGE", "v")]),
    "nested_add": (
        [("address", "RECORD", "NULLABLE", ADDRESS)],
        [("address", "RECORD", "NULLABLE", [*ADDRESS, leaf("zip")])],
        "ADDITIVE",
        [("ADD", "address.zip")],
    ),
    "nested_drop": (
        [("address", "RECORD", "NULLABLE", ADDRESS)],
        [("address", "RECORD", "NULLABLE", ADDRESS[:1])],
        "BREAKING",
        [("DROP", "address.city")],
    ),
    "mode_only": ([leaf("a")], [leaf("a", mode="REQUIRED")], "NONE", []),
    "record_to_string": (
        [("r", "RECORD", "NULLABLE", [leaf("x"), ("s", "RECORD", "NULLABLE", [leaf("y")])])],
        [leaf("r")],
        "BREAKING",
        [("TYPE_CHANGE", "r")],
    ),
    "added_record": (
        [ID],
        [ID, ("r", "RECORD", "NULLABLE", [leaf("x", mode="REQUIRED")])],
        "ADDITIVE",
        [("ADD", "r")],
    ),
    # The record is retyped, one child stays and another changes: only the record counts.
    "retyped_record_with_children": (
        [("r", "RECORD", "NULLABLE", [("k", "RECORD", "NULLABLE", [leaf("x")])])],
        [("r", "STRUCT", "NULLABLE", [("k", "RECORD", "NULLABLE", [leaf("x"), leaf("y")])])],
        "BREAKING",
        [("TYPE_CHANGE", "r")],
    ),
    "prefix_is_not_ancestor": (
        [("ab", "RECORD", "NULLABLE", [leaf("c")]), leaf("a")],
        [("ab", "RECORD", "NULLABLE", [leaf("c"), leaf("d")])],
        "BREAKING",
        [("DROP", "a"), ("ADD", "ab.d")],
    ),
}


def frame(spark, side):
    data = [r for name, case in CASES.items() for r in rows(name, case[side])]
    return spark.createDataFrame(data, registry.REGISTRY)


@pytest.fixture(scope="module")
def both(spark):
    return frame(spark, 0), frame(spark, 1)


def test_changes_and_classes(spark, both):
    changes = registry.diff(*both)
    found = {}
    for r in changes.collect():
        found.setdefault(r["table"], []).append((r["change"], r["path"]))
    tables = spark.createDataFrame([("d", name) for name in CASES], "dataset string, table string")
    classes = {r["table"]: r for r in registry.classify_changes(changes, tables).collect()}
    for name, (_, _, expected, paths) in CASES.items():
        assert sorted(found.get(name, []), key=lambda c: c[1]) == paths, name
        assert classes[name]["change_type"] == expected, name
        assert classes[name]["n_changes"] == len(paths), name
    assert classes["widen"]["widened"] and not classes["add_nullable"]["widened"]


def test_repeated_flip_is_reported_on_request(spark):
    old = spark.createDataFrame(list(rows("t", [leaf("a"), leaf("b")])), registry.REGISTRY)
    new = spark.createDataFrame(
        list(rows("t", [leaf("a", mode="REPEATED"), leaf("b", mode="REQUIRED")])), registry.REGISTRY
    )
    assert registry.diff(old, new).count() == 0
    flips = registry.diff(old, new, mode_flips_break=True).collect()
    assert [(r["change"], r["path"], r["breaking"]) for r in flips] == [("MODE_CHANGE", "a", True)]


def test_aliases_widen_on_request(spark):
    old = spark.createDataFrame(list(rows("t", [leaf("a", "INTEGER")])), registry.REGISTRY)
    new = spark.createDataFrame(list(rows("t", [leaf("a", "FLOAT")])), registry.REGISTRY)
    assert registry.diff(old, new).first()["breaking"]
    assert not registry.diff(old, new, use_aliases=True).first()["breaking"]


def expected_text(fields):
    parts = []
    for name, dtype, mode, children in sorted(fields):
        text = f"{name}\0{dtype}\0{mode}"
        parts.append(text + (f"\0{{{expected_text(children)}}}" if children else ""))
    return "\0".join(parts)


def test_fingerprint_follows_the_canonical_text(spark, both):
    for side in (0, 1):
        found = {r["table"]: r["schema_hash"] for r in registry.fingerprints(both[side]).collect()}
        for name, case in CASES.items():
            assert found[name] == hashlib.sha256(expected_text(case[side]).encode()).hexdigest(), name


def test_fingerprint_ignores_order_and_description(spark):
    deep = [("p", "RECORD", "NULLABLE", [leaf("z"), ("a", "INTEGER", "REQUIRED", [])]), leaf("q")]
    turned = [deep[1], ("p", "RECORD", "NULLABLE", deep[0][3][::-1])]
    data = [*rows("one", deep, description="x"), *rows("two", turned, description="y")]
    prints = registry.fingerprints(spark.createDataFrame(data, registry.REGISTRY)).collect()
    assert prints[0]["schema_hash"] == prints[1]["schema_hash"]


def test_widening_pairs(spark):
    pairs = {
        ("INT64", "FLOAT64"): True,
        ("INT64", "NUMERIC"): True,
        ("FLOAT64", "BIGNUMERIC"): True,
        ("NUMERIC", "BIGNUMERIC"): True,
        ("DATE", "TIMESTAMP"): True,
        ("DATETIME", "TIMESTAMP"): True,
        ("TIMESTAMP", "DATE"): False,
        ("INT64", "STRING"): False,
        ("STRING", "INT64"): False,
        ("INTEGER", "FLOAT"): False,
    }
    df = spark.createDataFrame(list(pairs), "a string, b string")
    for r in df.select("a", "b", classify.is_widening(F.col("a"), F.col("b")).alias("w")).collect():
        assert r["w"] == pairs[(r["a"], r["b"])], r


def test_flatten_nested_schema():
    schema = T.StructType.fromDDL(
        "id bigint, tags array<string>, addr struct<city:string,lines:array<struct<n:int>>>, price decimal(38,9)"
    )
    flat = {f[0]: (f[1], f[3], f[4], f[6]) for f in registry.flatten(schema, {"id": "REQUIRED"})}
    assert flat == {
        "id": ("", "INT64", "REQUIRED", 0),
        "tags": ("", "STRING", "REPEATED", 0),
        "addr": ("", "RECORD", "NULLABLE", 0),
        "addr.city": ("addr", "STRING", "NULLABLE", 1),
        "addr.lines": ("addr", "RECORD", "REPEATED", 1),
        "addr.lines.n": ("addr.lines", "INT64", "NULLABLE", 2),
        "price": ("", "NUMERIC", "NULLABLE", 0),
    }


def test_resolver_keeps_version_on_mode_change(spark):
    def today(fields):
        return spark.createDataFrame(list(rows("t", fields)), registry.REGISTRY).drop("version")

    first = registry.resolve(today([leaf("a")]), spark.createDataFrame([], "dataset string, table string, version bigint, shape_hash string"))
    r = first.first()
    assert (r["version"], r["is_new"]) == (1, True)
    stored = first.select("dataset", "table", "version", "shape_hash")
    same = registry.resolve(today([leaf("a", mode="REQUIRED")]), stored).first()
    assert (same["version"], same["is_new"]) == (1, False)
    wider = registry.resolve(today([leaf("a"), leaf("b")]), stored).first()
    assert (wider["version"], wider["is_new"]) == (2, True)


def test_acknowledged_version_is_current(spark):
    versions = spark.createDataFrame(
        [("d", "t", 1, "INITIAL"), ("d", "t", 2, "ADDITIVE"), ("d", "t", 3, "BREAKING")],
        "dataset string, table string, version bigint, change_type string",
    )
    none = spark.createDataFrame([], "dataset string, table string, version bigint")
    assert registry.current_version(versions, none).first()["current_version"] == 2
    acks = spark.createDataFrame([("d", "t", 3)], "dataset string, table string, version bigint")
    assert registry.current_version(versions, acks).first()["current_version"] == 3


def test_rename_candidates_need_one_pair(spark):
    old = [leaf("a"), leaf("b", "INT64"), leaf("x", "DATE"), leaf("y", "DATE")]
    new = [leaf("c"), leaf("d", "FLOAT64"), leaf("z", "DATE")]
    frames = [spark.createDataFrame(list(rows("t", s)), registry.REGISTRY) for s in (old, new)]
    found = {r["type"]: r for r in registry.rename_candidates(registry.diff(*frames)).collect()}
    assert set(found) == {"STRING", "DATE"}
    assert (found["STRING"]["renamed_from"], found["STRING"]["renamed_to"]) == ("a", "c")
    assert found["DATE"]["renamed_from"] is None and found["DATE"]["n_dropped"] == 2


def test_items_are_grouped_without_sorting(spark, tmp_path):
    flags = ["A", "N", "R", "", "B", "a", None, "M"]
    rows = [(i, 1, 5, 9, f, s, dt.datetime(2024, 1, 1 + i)) for i, (f, s) in enumerate(zip(flags, "OFPOOFOO"))]
    rows += [(9, 1, 5, 9, f, "O", dt.datetime(2024, 2, 1)) for f in ("A", None, "N")]
    columns = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string"
    spark.createDataFrame(rows, f"{columns}, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    modes = {"A": "NULLABLE", "N": "REQUIRED"}
    items = schemas._items(spark, str(tmp_path))
    assert "SortAggregate" not in items._jdf.queryExecution().toString()
    got = {r["table"]: r["mode"] for r in items.collect()}
    assert got == {f"t{i}": modes.get(f, "REPEATED") for i, f in enumerate(flags)} | {"t9": "REQUIRED"}
    observed = schemas._observed(spark, str(tmp_path))
    assert "SortAggregate" not in observed._jdf.queryExecution().toString()
    assert sorted({(r["type"], r["mode"]) for r in observed.collect()}) == [("FLOAT64", "NULLABLE"), ("STRING", "REQUIRED")]


def test_diff_joins_on_a_hash_first(spark):
    field = "dataset string, table string, path string, type string, mode string"
    old = spark.createDataFrame([("d", "t", "a", "INT64", ""), ("d", None, "x", "INT64", "")], field)
    new = spark.createDataFrame([("d", "t", "a", "STRING", ""), ("d", "t", "b.c", "DATE", ""), ("d", None, "x", "INT64", "")], field)
    changes = registry.diff(old, new)
    assert KEY_HASH in changes._jdf.queryExecution().toString() and KEY_HASH not in changes.columns
    got = sorted((r["table"] or "", r["path"], r["change"]) for r in changes.collect())
    # Tables without a name equal none.
    assert got == [("", "x", "ADD"), ("", "x", "DROP"), ("t", "a", "TYPE_CHANGE"), ("t", "b.c", "ADD")]


def test_ancestors_are_found_by_compiled_steps(spark):
    """Odd paths, null ones and repeated rows; only rows with ancestors meet the changes above them."""
    field = "dataset string, table string, path string, type string, mode string"
    paths = ["a", "a.b", "a.b.c", "ab.c", "a..x", ".y", "z.", "z", "q.r.s.t", "q.r", "q.r", "q.r.s.t", None]
    new = spark.createDataFrame([("d", "t", p, "INT64", "") for p in paths], field)
    changes = registry.diff(spark.createDataFrame([], field), new)
    plan = changes._jdf.queryExecution().toString()
    assert "Union" in plan and "transform(" not in plan and "lambda" not in plan
    got = sorted((r["path"] or "null") for r in changes.collect())
    held = {p for p in paths if p}
    kept = [p or "null" for p in paths if not p or not any(p[:i] in held for i in range(len(p)) if p[i] == ".")]
    assert got == sorted(kept) and "a..x" not in got and ".y" in got


def test_diff_writes_nothing_and_shuffles_its_sides_once(spark, monkeypatch):
    """One exchange for both sides; none where the rows are laid out by key, of whatever sizes the sides are."""
    monkeypatch.delattr(registry, "stored")
    sql = ["concat('d', id % 3) as dataset", "concat('t', id % 3000) as table", "concat('f', id % 7) as path", "if(id % 10 = 9, 'STRING', 'INT64') as type", "'' as mode"]
    new = spark.range(10, 20_010).selectExpr(sql)
    old = spark.range(900).selectExpr(sql).withColumn("type", F.lit("INT64"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        plain, laid = registry.diff(old, new), registry.diff(*(x.repartition(8, "dataset", "table") for x in (old, new)))
        for changes, exchanges in ((plain, 1), (laid, 2)):
            assert changes._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == exchanges
        got = [sorted(map(repr, x.collect())) for x in (plain, laid)]
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    joined = old.withColumnRenamed("type", "before").join(new.withColumnRenamed("type", "after"), ["dataset", "table", "path"], "full")
    want = joined.where("before is distinct from after").count()
    assert got[0] == got[1] and len(got[0]) == want and {c for c in ("ADD", "DROP", "TYPE_CHANGE") if f"'{c}'" in str(got)} == {"ADD", "DROP", "TYPE_CHANGE"}


def test_diff_of_repeated_and_null_rows(spark):
    """Repeated paths meet as pairs, nulls meet nothing; what is below a change goes, whatever sorts in between."""
    paths = ["a", "a-x", "a.b", "a.b.c", "a/x", "a0", "ab", "a.-", "é", "é.x", "r", "r.s", "r.s.t", "", ".q", None]
    rng = random.Random(5)
    rows = [
        [(rng.choice(["d", None]), rng.choice(["t", "u"]), rng.choice(paths), rng.choice(["INT64", "STRING", None]), rng.choice(["", None, "REPEATED", "REQUIRED"])) for _ in range(120)]
        for _ in range(2)
    ]
    frames = [spark.createDataFrame(r, "dataset string, table string, path string, type string, mode string") for r in rows]
    mode = lambda m: m or "NULLABLE"
    for flips in (False, True):
        pairs = [(o, n) for o in rows[0] for n in rows[1] if None not in o[:3] and o[:3] == n[:3]]
        pairs += [(o, None) for o in rows[0] if not any(o is p[0] for p in pairs)] + [(None, n) for n in rows[1] if not any(n is p[1] for p in pairs)]
        found = []
        for o, n in pairs:
            before, after = o[3] if o else None, n[3] if n else None
            flip = bool(flips and o and n and (mode(o[4]) == "REPEATED") != (mode(n[4]) == "REPEATED"))
            change = "ADD" if before is None else "DROP" if after is None else "TYPE_CHANGE" if before != after else "MODE_CHANGE" if flip else None
            if change:
                found.append((*(o or n)[:3], change, before, after, mode(o[4]) if o else None, mode(n[4]) if n else None))
        above = {f[:3] for f in found if None not in f[:3] and f[3] != "MODE_CHANGE"}
        want = [f for f in found if f[2] is None or not any((*f[:2], f[2][:i]) in above for i, c in enumerate(f[2]) if c == ".")]
        got = [tuple(r)[:8] for r in registry.diff(*frames, mode_flips_break=flips).collect()]
        assert 0 < len(want) < len(found) and sorted(got, key=repr) == sorted(want, key=repr)


def test_tables_are_those_of_the_items(spark, tmp_path):
    """The tables of a classification are read without their items, and meet the changes where those lie."""
    columns = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string"
    rows = [(k, n, k + n if k else 3, n * (k or 5) + 1, "ANR"[n % 3]) for k in (1, 2, 2, 6, -3, None, None, 40) for n in (1, 2, 2, 3)]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    items = schemas._items(spark, str(tmp_path)).select("dataset", "table").distinct()
    tables = schemas._tables(spark, str(tmp_path))
    assert sorted(map(repr, tables.distinct().collect())) == sorted(map(repr, items.collect())) and items.count() == 6
    plan = schemas.schema_classify(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # The items' own two exchanges, for each side of the diff, and one of the tables.
    assert plan.count("Exchange hashpartitioning") == 5


def test_rename_candidates_are_found_where_the_changes_lie(spark, tmp_path):
    rows = [(k, n, k + n, n * k + 1, "ANR"[n % 3]) for k in range(1, 30) for n in range(1, 5)]
    columns = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = schemas.rename_candidates(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4 and "Join" not in plan

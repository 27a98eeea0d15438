import json
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import tablecheck as tc
from tablecheck.operators import rowdiff
from tablecheck.operators.rowdiff import cells_by_column

from test_hashing import GOLDEN_HASH, GOLDEN_ROW, GOLDEN_SCHEMA

SCHEMA = "k int, v string"


def classes(diff):
    return dict(Counter(r["mismatch_type"] for r in diff.collect()))


def keys(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize(
    "table, expected, duplicates, every",
    [
        ("customer", (4, 2, 2), (0, 1), (4, 2, 2)),
        ("orders", (0, 0, 1), (0, 0), (0, 0, 1)),
        ("events", (50, 1, 6), (0, 0), (50, 1, 6)),
        ("lineitem", (8, 14, 3), (1401, 1401), (3373, 16, 5)),
    ],
)
def test_expected_values(derived, table, expected, duplicates, every):
    spec = derived(table)
    pair = tc.align(spec)
    names = ("HASH_MISMATCH", "MISSING_IN_SOURCE", "MISSING_IN_TARGET")
    found = classes(tc.row_diff(pair))
    assert tuple(found.get(n, 0) for n in names) == expected
    counted = [tc.duplicate_count(df, spec.keys).first()[0] for df in (spec.source, spec.target)]
    assert tuple(counted) == duplicates
    totals = tc.row_diff_all(pair).groupBy("mismatch_type").agg(F.sum("n_pairs")).collect()
    totals = {r[0]: int(r[1]) for r in totals}
    assert tuple(totals.get(n, 0) for n in names) == every


def test_captured_run(spark, run):
    """1,000 rows against 999, the second row lost."""
    others = [(i, f"f{i}", f"l{i}", f"{i}@x.org", "x", "2024-01-01") for i in range(1, 1001) if i != 2]
    source = spark.createDataFrame([GOLDEN_ROW, *others], GOLDEN_SCHEMA)
    target = spark.createDataFrame(others, GOLDEN_SCHEMA)
    pair = tc.align(tc.PairSpec("customer", source, target, ["id"], hash_mode="compat"))
    assert len(pair.columns) == 5
    rows = tc.with_details(pair, tc.row_diff(pair)).collect()
    assert [tuple(r) for r in rows] == [
        (
            '{"id":2}',
            "MISSING_IN_TARGET",
            GOLDEN_HASH,
            None,
            '{"source_record":{"first_name":"Chaim","last_name":"Batcheldor",'
            '"email":"cbatcheldor1@businessweek.com","gender":"Agender","timestamp":"2024-06-29"},'
            '"target_record":null}',
        )
    ]


def test_same_table_has_no_difference(derived):
    for table in ("customer", "events"):
        spec = derived(table)
        same = tc.align(tc.PairSpec("x", spec.target.filter("true"), spec.target, spec.keys))
        found = tc.row_diff(same)
        # Rows with a null key match nothing, not even themselves.
        assert found.filter(F.col(spec.keys[0]).isNotNull()).count() == 0


def test_swapping_sides_swaps_the_missing_classes(derived):
    spec = derived("lineitem")
    there = classes(tc.row_diff(tc.align(spec)))
    back = classes(tc.row_diff(tc.align(tc.PairSpec("x", spec.target, spec.source, spec.keys))))
    assert back["HASH_MISMATCH"] == there["HASH_MISMATCH"]
    assert back["MISSING_IN_SOURCE"] == there["MISSING_IN_TARGET"]
    assert back["MISSING_IN_TARGET"] == there["MISSING_IN_SOURCE"]


def test_partitioning_does_not_matter(derived):
    spec = derived("lineitem")
    shuffled = replace(spec, source=spec.source.repartition(7), target=spec.target.orderBy(F.rand(1)).repartition(3))
    one = {tuple(r) for r in tc.row_diff(tc.align(spec)).collect()}
    two = {tuple(r) for r in tc.row_diff(tc.align(shuffled)).collect()}
    assert one == two


def test_classes_add_up(derived):
    pair = tc.align(derived("lineitem"))
    diff = tc.row_diff(pair).collect()
    parts = Counter(
        MISSING_IN_SOURCE=tc.missing_in_source(pair).count(),
        MISSING_IN_TARGET=tc.missing_in_target(pair).count(),
        HASH_MISMATCH=tc.hash_mismatch(pair).count(),
    )
    assert parts == Counter(r["mismatch_type"] for r in diff)


def test_null_keys_are_missing_on_both_sides(pair_of):
    pair = pair_of([(None, "a"), (1, "a")], [(None, "a"), (None, "b"), (1, "a")], ["k"], SCHEMA)
    assert classes(tc.row_diff(pair)) == {"MISSING_IN_SOURCE": 1, "MISSING_IN_TARGET": 1}
    every = {r["mismatch_type"]: int(r["n_pairs"]) for r in tc.row_diff_all(pair).collect()}
    assert every == {"MISSING_IN_SOURCE": 2, "MISSING_IN_TARGET": 1}
    details = tc.with_details(pair, tc.row_diff(pair)).collect()
    sides = {r["mismatch_type"]: json.loads(r["details"]) for r in details}
    assert sides["MISSING_IN_TARGET"] == {"source_record": {"v": "a"}, "target_record": None}
    assert sides["MISSING_IN_SOURCE"]["source_record"] is None


def test_composite_key_with_a_null_part(pair_of):
    rows = [(1, None, "a"), (1, 2, "a")]
    pair = pair_of(rows, rows, ["k", "l"], "k int, l int, v string")
    found = tc.row_diff(pair)
    assert keys(found, "mismatch_type") == [("MISSING_IN_SOURCE",), ("MISSING_IN_TARGET",)]
    assert {(r["k"], r["l"]) for r in found.collect()} == {(1, None)}


def test_keys_only_compares_presence(pair_of):
    pair = pair_of([(1,), (2,)], [(2,), (3,)], ["k"], "k int")
    assert pair.columns == []
    diff = tc.row_diff(pair)
    assert classes(diff) == {"MISSING_IN_SOURCE": 1, "MISSING_IN_TARGET": 1}
    assert tc.with_light_details(pair, diff).count() == 2
    assert tc.with_details(pair, diff).count() == 2


@pytest.mark.parametrize("source, target", [([], [(1, "a")]), ([(1, "a")], []), ([], [])])
def test_empty_tables(pair_of, source, target):
    pair = pair_of(source, target, ["k"], SCHEMA)
    expected = {}
    if source:
        expected = {"MISSING_IN_TARGET": 1}
    if target:
        expected = {"MISSING_IN_SOURCE": 1}
    assert classes(tc.row_diff(pair)) == expected
    assert tc.duplicate_count(pair.source, ["k"]).first()[0] == 0


def test_duplicates_on_both_sides(pair_of):
    """The smallest hash stands for a key, so equal sets of copies agree."""
    source = [(1, "a"), (1, "b"), (2, "x"), (2, "x"), (3, "p")]
    target = [(1, "b"), (1, "a"), (1, "a"), (2, "x"), (3, "q"), (3, "q")]
    pair = pair_of(source, target, ["k"], SCHEMA)
    assert keys(tc.row_diff(pair), "k") == [(3,)]
    every = {(r["k"], r["mismatch_type"]): int(r["n_pairs"]) for r in tc.row_diff_all(pair).collect()}
    # key 1: 2 x 3 comparisons, of which a-a twice and b-b once agree; key 3: 1 x 2
    assert every == {(1, "HASH_MISMATCH"): 3, (3, "HASH_MISMATCH"): 2}
    groups = {(r["k"], r["n_source"], r["n_target"]) for r in tc.hash_groups(pair).collect()}
    assert groups == {(1, 1, 2), (1, 1, 1), (2, 2, 1), (3, 1, 0), (3, 0, 2)}


def test_one_key_with_a_third_of_the_rows(spark):
    """A hot key is combined before the shuffle and its comparisons are counted, not listed."""
    n = 30_000
    base = spark.range(n).selectExpr("if(id % 3 = 0, -1L, id) as k", "cast(id % 7 as string) as v")
    pair = tc.align(tc.PairSpec("hot", base, base.filter("k <> 4"), ["k"]))
    assert classes(tc.row_diff(pair)) == {"MISSING_IN_TARGET": 1}
    hot = n // 3
    per_value = Counter((i * 3) % 7 for i in range(hot))
    expected = hot * hot - sum(c * c for c in per_value.values())
    found = {r["k"]: int(r["n_pairs"]) for r in tc.row_diff_all(pair).collect()}
    assert found == {-1: expected, 4: 1}
    assert tc.duplicate_count(base, ["k"]).first()[0] == hot - 1
    assert tc.dedupe(base, ["k"]).count() == n - hot + 1


def test_counts_of_comparisons_do_not_overflow(spark):
    """Two hot keys of four thousand million rows would list more pairs than a long holds."""
    from tablecheck.operators import rowdiff

    big = spark.range(1).selectExpr(
        "1 as k", "cast(null as boolean) as __tc_apart", "4000000000L as __tc_n_source",
        "4000000000L as __tc_n_target", "'h' as __tc_hash",
    )
    original = rowdiff._hash_counts
    rowdiff._hash_counts = lambda pair: big.unionAll(big.withColumn("__tc_hash", F.lit("i")))
    try:
        pair = tc.align(tc.PairSpec("x", big.select("k"), big.select("k"), ["k"]))
        assert int(tc.row_diff_all(pair).first()["n_pairs"]) == 2 * 4_000_000_000**2
    finally:
        rowdiff._hash_counts = original


def test_row_diff_all_counts_the_real_join(derived):
    pair = tc.align(derived("lineitem"))
    digest = tc.row_hash(pair.schema, pair.columns)
    s = pair.source.select(*pair.keys, digest.alias("h")).alias("s")
    t = pair.target.select(*pair.keys, digest.alias("h")).alias("t")
    same = (F.col("s.l_orderkey") == F.col("t.l_orderkey")) & (
        F.col("s.l_linenumber") == F.col("t.l_linenumber")
    )
    joined = s.join(t, same, "full_outer").filter("s.h is null or t.h is null or s.h <> t.h")
    assert tc.row_diff_all(pair).agg(F.sum("n_pairs")).first()[0] == joined.count()


def test_fast_hash_finds_the_same_keys(derived):
    for table in ("customer", "events", "lineitem"):
        slow = tc.row_diff(tc.align(derived(table)))
        fast = tc.row_diff(tc.align(derived(table, hash_algo="xxhash64")))
        slow = {tuple(r) for r in slow.drop("source_row_hash", "target_row_hash").collect()}
        fast = {tuple(r) for r in fast.drop("source_row_hash", "target_row_hash").collect()}
        if table != "lineitem":  # another hash picks another row among differing copies
            assert slow == fast


def test_strict_mode_tells_null_from_its_marker(pair_of):
    source, target = [(1, None)], [(1, "NULL")]
    assert tc.row_diff(pair_of(source, target, ["k"], SCHEMA)).count() == 0
    strict = pair_of(source, target, ["k"], SCHEMA, hash_mode="strict")
    diff = tc.row_diff(strict)
    assert classes(diff) == {"HASH_MISMATCH": 1}
    cells = tc.cell_diff(strict, diff).collect()
    assert [(r["column_name"], r["source_value"], r["target_value"]) for r in cells] == [
        ("v", None, "NULL")
    ]


def test_cells(derived):
    pair = tc.align(derived("customer"))
    diff = tc.row_diff(pair)
    found = {r["column_name"]: r["n_cells"] for r in cells_by_column(tc.cell_diff(pair, diff)).collect()}
    assert found == {"c_acctbal": 2, "c_mktsegment": 2}


def test_user_columns_named_like_results(pair_of):
    schema = "k int, mismatch_type string, n_source int, status string"
    source, target = [(1, "a", 1, "x"), (2, "b", 2, "y")], [(1, "a", 1, "x"), (2, "b", 3, "y")]
    pair = pair_of(source, target, ["k"], schema)
    diff = tc.row_diff(pair)
    assert keys(diff, "k", "mismatch_type") == [(2, "HASH_MISMATCH")]
    assert json.loads(tc.with_details(pair, diff).first()["details"])["target_record"]["n_source"] == 3
    cell = tc.cell_diff(pair, diff).first()
    assert (cell["column_name"], cell["source_value"], cell["target_value"]) == ("n_source", "2", "3")


def test_odd_column_names(pair_of):
    schema = "`my key` int, `a.b` string, `it's` string"
    pair = pair_of([(1, "x", "y")], [(1, "x", "z")], ["my key"], schema)
    diff = tc.row_diff(pair)
    cells = tc.cell_diff(pair, diff).collect()
    assert [(r["my key"], r["column_name"]) for r in cells] == [(1, "it's")]
    assert tc.dedupe(pair.source, ["my key"]).columns == ["my key", "a.b", "it's"]


def test_target_keys_may_have_other_names(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    target = spark.createDataFrame([(1, "a"), (3, "b")], "customer_id int, v string")
    pair = tc.align(tc.PairSpec("x", source, target, ["id"], target_keys=["customer_id"]))
    assert classes(tc.row_diff(pair)) == {"MISSING_IN_SOURCE": 1, "MISSING_IN_TARGET": 1}


def test_dedupe_keeps_the_smallest_hash(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d")], SCHEMA)
    kept = tc.dedupe(df, ["k"])
    ranked = sorted(("a", "b"), key=lambda v: tc_hash(v))
    assert keys(kept.filter("k = 1"), "v") == [(ranked[0],)]
    assert kept.count() == 3


def tc_hash(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def shuffles(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning"), plan


@pytest.mark.parametrize("table", ["customer", "events", "lineitem"])
def test_row_diff_sorts_nothing_and_shuffles_keys_once_a_step(derived, table):
    pair = tc.align(derived(table))
    n, plan = shuffles(rowdiff.screened(pair))
    assert n == 1 and "Join" not in plan and "sha2" not in plan and "Sort" not in plan
    n, plan = shuffles(tc.row_diff(pair))
    assert "Sort" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    n, plan = shuffles(tc.row_diff(replace(pair, screen=False)))
    assert n == 1 and "Join" not in plan and "Sort" not in plan


@pytest.mark.parametrize("screen", [True, False])
@pytest.mark.parametrize("algo", ["sha256", "xxhash64"])
def test_rows_left_over_among_repeated_keys(pair_of, screen, algo):
    source = [(1, "A"), (1, "B"), (2, "A"), (2, "A"), (3, "x"), (4, "y"), (4, "z"), (None, "n"), (None, "n"), (6, "q")]
    target = [(1, "A"), (1, "C"), (2, "A"), (3, "x"), (4, "z"), (4, "y"), (5, "w"), (None, "n"), (6, "q"), (6, "q"), (6, "r")]
    pair = pair_of(source, target, ["k"], "k int, v string", screen=screen, hash_algo=algo)
    found = [(r["k"], r["mismatch_type"], r["source_row_hash"] is not None, r["n_rows"]) for r in tc.row_surplus(pair).collect()]
    assert sorted(found, key=repr) == sorted(
        [
            (1, "HASH_MISMATCH", True, 1),
            (1, "HASH_MISMATCH", False, 1),
            (2, "MISSING_IN_TARGET", True, 1),
            (5, "MISSING_IN_SOURCE", False, 1),
            (6, "MISSING_IN_SOURCE", False, 1),
            (6, "MISSING_IN_SOURCE", False, 1),
            (None, "MISSING_IN_TARGET", True, 2),
            (None, "MISSING_IN_SOURCE", False, 1),
        ],
        key=repr,
    )
    if algo == "sha256":
        rows = {(r["primary_key_value"], r["details"]) for r in tc.with_details(pair, tc.row_surplus(pair)).collect()}
        assert ('{"k":1}', '{"source_record":{"v":"B"},"target_record":null}') in rows
        assert ('{"k":1}', '{"source_record":null,"target_record":{"v":"C"}}') in rows and len(rows) == 8


def test_screen_leaves_what_only_the_text_decides(pair_of):
    """Values differ, but their texts agree; and the other way round."""
    source, target = [(1, None, 0.0), (2, "a||b", 1.0)], [(1, "NULL", 0.0), (2, "a||b", -0.0)]
    pair = pair_of(source, target, ["k"], "k int, v string, w double", hash_mode="compat")
    assert [(r["k"], r["mismatch_type"]) for r in tc.row_diff(pair).collect()] == [(2, "HASH_MISMATCH")]


def test_presence_reads_keys_only(derived):
    pair = tc.align(derived("orders"))
    n, plan = shuffles(tc.missing_in_source(pair))
    assert n == 1
    assert "o_totalprice" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("seed", range(4))
def test_random_tables_against_brute_force(pair_of, seed):
    import hashlib
    import random

    rng = random.Random(seed)

    def table():
        rows = rng.randrange(0, 40)
        keys = (None, 1, 2, 3, 4, 5, 6)
        return [(rng.choice(keys), rng.choice((1, 2)), rng.choice("abc")) for _ in range(rows)]

    source, target = table(), table()
    pair = pair_of(source, target, ["k", "l"], "k int, l int, v string")

    def by_key(rows):
        out = {}
        for k, l, v in rows:
            out.setdefault((k, l), []).append(hashlib.sha256(v.encode()).hexdigest())
        return out

    s, t = by_key(source), by_key(target)
    expected, every = set(), {}
    for key in s.keys() | t.keys():
        sides = [(s.get(key), t.get(key))]
        if key[0] is None:
            sides = [(s.get(key), None), (None, t.get(key))]
        for left, right in sides:
            if left and right:
                pairs = sum(a != b for a in left for b in right)
                if min(left) != min(right):
                    expected.add((*key, "HASH_MISMATCH", min(left), min(right)))
                if pairs:
                    every[(*key, "HASH_MISMATCH")] = pairs
            elif left:
                expected.add((*key, "MISSING_IN_TARGET", min(left), None))
                every[(*key, "MISSING_IN_TARGET")] = len(left)
            elif right:
                expected.add((*key, "MISSING_IN_SOURCE", None, min(right)))
                every[(*key, "MISSING_IN_SOURCE")] = len(right)
    assert {tuple(r) for r in tc.row_diff(pair).collect()} == expected
    found = {(r["k"], r["l"], r["mismatch_type"]): int(r["n_pairs"]) for r in tc.row_diff_all(pair).collect()}
    assert found == every
    extra = sum(len(v) - 1 for v in s.values())
    assert tc.duplicate_count(pair.source, ["k", "l"]).first()[0] == extra
    assert {tuple(r) for r in tc.row_diff(replace(pair, screen=False)).collect()} == expected
    left = {}
    for side, rows, other in (("s", source, target), ("t", target, source)):
        for row, n in Counter(rows).items():
            more = n - (0 if row[0] is None else Counter(other)[row])
            if more > 0:
                left[side, *row[:2], hashlib.sha256(row[2].encode()).hexdigest()] = more
    got = {("s" if r["source_row_hash"] else "t", r["k"], r["l"], r["source_row_hash"] or r["target_row_hash"]): r["n_rows"] for r in tc.row_surplus(pair).collect()}
    assert got == left
    for buckets in (1, 4, 64):
        narrowed = {tuple(r) for r in tc.narrowed_row_diff(pair, buckets).collect()}
        assert narrowed == expected


def test_keys_that_differ_are_found_once(derived):
    """Neither side of the second read finds them again, and no table is shuffled for them."""
    pair = tc.align(derived("customer"))
    for diff in (rowdiff.compared(pair)[1], tc.row_surplus(pair)):
        plan = diff._jdf.queryExecution().executedPlan().toString()
        assert "__tc_x0" not in plan and plan.count("BroadcastHashJoin") >= 2 and "LeftSemi" in plan
    plan = shuffles(tc.row_diff(pair))[1]
    assert "ReusedExchange" in plan

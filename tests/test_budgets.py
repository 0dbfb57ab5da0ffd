import random
from decimal import Decimal
from fractions import Fraction
from itertools import groupby

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clipquarry.operators import budgets, ordering
from clipquarry.operators.exact import adder
from clipquarry.operators.prefix import quantile_row
from clipquarry.plans import curation

WAYS = [None, 0]  # all totals in one task, or range-partitioned


def clip_rows(n=400, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all rows share one score
        score = 7 if i % 3 == 0 else draw.choice([None, 1, 2, 7, *range(20, 60)])
        rows.append((i, f"p{i % 4}", score, draw.randint(0, 50)))
    return rows


@pytest.fixture(scope="module")
def clips(spark):
    return spark.createDataFrame(clip_rows(), "id long, part string, score int, amount long").cache()


def range_totals(rows):
    order = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0)))
    total, found = 0, {}
    for _, group in groupby(order, key=lambda r: r[2]):
        group = list(group)
        total += sum(r[3] for r in group)
        found.update({r[0]: total for r in group})
    return found


@pytest.mark.parametrize("way", WAYS)
def test_running_budget(clips, way):
    found = budgets.running_budget(clips, "score", "amount", one_task_rows=way).collect()
    assert {r["id"]: r["running_total"] for r in found} == range_totals(clip_rows())


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("limit", [0, 500, 4_000, 10**9])
def test_running_budget_cut(clips, way, limit):
    found = budgets.running_budget(clips, "score", "amount", limit=limit, one_task_rows=way).collect()
    expected = {i: t for i, t in range_totals(clip_rows()).items() if t <= limit}
    assert {r["id"]: r["running_total"] for r in found} == expected


@pytest.mark.parametrize("way", WAYS)
def test_budget_per_part(clips, way):
    found = budgets.running_budget(clips, "score", "amount", "t", ["part"], 900, way).collect()
    expected = {}
    for part in {"p0", "p1", "p2", "p3"}:
        totals = range_totals([r for r in clip_rows() if r[1] == part])
        expected.update({i: t for i, t in totals.items() if t <= 900})
    assert {r["id"]: r["t"] for r in found} == expected


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("limit", [0, 10, 777, 2_000, 5_000, 8_000, 10**9])
def test_take_within_budget_is_the_loop(clips, way, limit):
    kept = budgets.take_within_budget(clips, "score", "amount", limit, ["id"], way).collect()
    total, expected = 0, set()
    for row in sorted(clip_rows(), key=lambda r: (r[2] is None, -(r[2] or 0), r[0])):
        total += row[3]
        if total > limit:
            break
        expected.add(row[0])
    assert {r["id"] for r in kept} == expected


def test_rows_alike_in_the_tie_break_stay_together(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (1, 2, 1)], "score int, tie int, amount long")
    assert budgets.take_within_budget(df, "score", "amount", 7, ["tie"]).count() == 0
    assert budgets.take_within_budget(df, "score", "amount", 10, ["tie"]).count() == 2


def test_negative_amounts_fail(spark):
    df = spark.createDataFrame([(1, -1)], "score int, amount long")
    with pytest.raises(Exception, match="negative amount"):
        budgets.take_within_budget(df, "score", "amount", 5, ["score"]).collect()


def test_missing_amount_counts_as_nothing(spark):
    df = spark.createDataFrame([(2, None), (1, 5)], "score int, amount long")
    assert budgets.take_within_budget(df, "score", "amount", 5, ["score"]).count() == 2


@pytest.mark.parametrize("limit", [300, 900])
def test_pre_prune_loses_nothing(clips, limit):
    pruned = budgets.partitioned_budget(clips, "part", "score", "amount", 900)
    two_phase = budgets.running_budget(pruned, "score", "amount", limit=limit)
    one_phase = budgets.running_budget(clips, "score", "amount", limit=limit)
    assert {r["id"] for r in two_phase.collect()} == {r["id"] for r in one_phase.collect()}


def test_empty_input(spark):
    none = spark.createDataFrame([], "id long, score int, amount long")
    assert budgets.running_budget(none, "score", "amount", limit=5).count() == 0
    assert budgets.take_within_budget(none, "score", "amount", 5, ["id"]).count() == 0


@pytest.mark.parametrize("way", WAYS)
def test_quantiles(spark, way):
    import numpy as np

    draw = random.Random(5)
    values = [3.5] * 150 + [draw.random() * 100 for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    row = quantile_row(df, "v", [0.5, 0.9, 0.99], True, way)
    assert row["n"] == len(values)
    assert row["mean"] == pytest.approx(np.mean(values))
    assert row["var_pop"] == pytest.approx(np.var(values))
    for i, p in enumerate((50, 90, 99)):
        assert row[f"q{i}"] == pytest.approx(np.percentile(values, p))


def test_quantiles_of_nothing(spark):
    row = quantile_row(spark.createDataFrame([], "v double"), "v", [0.5])
    assert (row["n"], row["mean"], row["var_pop"], row["q0"]) == (0, None, None, None)


@pytest.mark.parametrize("within", [[], ["part"]])
def test_number_rows(spark, clips, within):
    rows = ordering.number_rows(
        clips.repartition(7), ["score", "id"], [False, True], within=within
    ).collect()
    by_part = {}
    for row in rows:
        by_part.setdefault(row["part"] if within else None, []).append(row)
    for part in by_part.values():
        order = sorted(part, key=lambda r: (r["score"] is None, -(r["score"] or 0), r["id"]))
        assert [r["Index"] for r in order] == list(range(len(order)))


def test_keep_latest_and_first_labelled(spark):
    rows = [("a", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, ""), ("c", 5, "z")]
    df = spark.createDataFrame(rows, "key string, at int, label string")
    latest = ordering.keep_latest(df, "key", F.col("at").desc())
    assert {(r["key"], r["at"], r["rn"]) for r in latest.collect()} == {("a", 3, 1), ("b", 1, 1), ("c", 5, 1)}
    first = ordering.first_labelled_per_id(df, "key", "label", "at")
    assert {(r["key"], r["label"]) for r in first.collect()} == {("a", "x"), ("c", "z")}
    assert ordering.sample_head(df, None, "at").count() == 5


def test_top_hours(spark):
    rows = [
        ("f1", 1800, "Ann met Bob", ["B-person", "O", "B-person"]),
        ("f2", 1800, "Ann ran off", ["B-person", "O", "O"]),
        ("f3", 1000, "", []),
        ("f4", 1800, None, None),
    ]
    df = spark.createDataFrame(
        rows, "raw_filepath string, duration long, human_transcript_text string, tags array<string>"
    ).withColumns(
        {
            "entities": F.lit(None).cast("array<struct<text:string,label:string>>"),
            "pos": F.lit(None).cast("array<string>"),
        }
    )
    chosen = curation.select_top_hours(df, "tagged_words", 1).collect()
    assert {r["raw_filepath"]: r["proper_noun_ratio"] for r in chosen} == {"f1": 2 / 3, "f2": 1 / 3}
    everything = {r["raw_filepath"]: r for r in curation.select_top_hours(df, "tagged_words", 10).collect()}
    assert everything["f4"]["proper_noun_ratio"] == 0 and everything["f4"]["tag_distribution"] == {}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("limit", [None, 10])
def test_null_amounts_are_those_of_a_window(spark, way, limit):
    rows = [(3, None), (3, None), (2, 5), (1, None), (0, 4), (None, 3)]
    df = spark.createDataFrame(rows, "score int, amount long")
    window = Window.orderBy(F.col("score").desc_nulls_last())
    want = df.withColumn("running_total", F.sum("amount").over(window))
    want = want if limit is None else want.filter(F.col("running_total") <= limit)
    found = budgets.running_budget(df, "score", "amount", limit=limit, one_task_rows=way)
    assert sorted(map(str, found.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_floating_amounts_do_not_depend_on_the_way(spark):
    draw = random.Random(9)
    rows = [(draw.randrange(40), draw.random() / 3) for _ in range(500)]
    df = spark.createDataFrame(rows, "score int, amount double").repartition(7)
    for limit in (1.0, sum(a for s, a in rows if s > 20), 40.0):
        one, ranges = (
            {(r["score"], r["amount"], r["running_total"]) for r in budgets.running_budget(df, "score", "amount", limit=limit, one_task_rows=w).collect()}
            for w in WAYS
        )
        assert one == ranges


def test_a_cap_below_the_limit_is_refused(spark):
    with pytest.raises(ValueError, match="can lose rows"):
        curation.curate_basic(spark.range(1), "email", limit=100, cap=50)
    with pytest.raises(ValueError, match="can lose rows"):
        curation.curate_categories(spark.range(1), ["email"], limit=100, cap=50)


# --- exact totals of floating amounts ---------------------------------------------------------------


def odd_amounts(n, seed):
    draw = random.Random(seed)
    sizes = [lambda: draw.random() / 3, lambda: 10.0 ** draw.uniform(-300, 300), lambda: draw.randrange(1000) / 8,
             lambda: 5e-324 * draw.randrange(1, 9), lambda: 0.0, lambda: 1e19, lambda: 1e-11, lambda: 0.1]
    return [draw.choice(sizes)() for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_sums_of_any_doubles_are_exact(spark, seed):
    amounts = odd_amounts(300, seed)
    amounts += [-a for a in odd_amounts(200, seed + 9)]
    df = spark.createDataFrame([(a,) for a in amounts], "x double").repartition(5)
    add = adder(df, F.col("x"))
    found = df.agg(*add.sums(F.col("x"))).select(add.value([F.col(n) for n in add.names]).alias("t")).first()["t"]
    want = sum(map(Fraction, amounts))
    assert found == pytest.approx(float(want), rel=1e-15)
    kept = sum(Fraction(2) ** (24 * (add.low + k)) * v for k, v in enumerate(df.agg(*add.sums(F.col("x"))).first()))
    assert kept == want


@pytest.mark.parametrize("seed, ways", [(0, [(None, 5)]), (1, [(None, 3), (0, 7)])])
def test_limits_keep_the_same_rows_as_totals(spark, seed, ways):
    draw = random.Random(seed)
    rows = [(draw.choice([None, 7.0, 7.0, draw.uniform(0, 60)]), a, i) for i, a in enumerate(odd_amounts(250, seed))]
    if seed:  # sizes that meet, so that lower limbs decide; seed 0 has all sizes from 1e-300 to 1e300
        rows = [(s, draw.random() * 10 ** draw.randrange(-9, 3), i) for s, _, i in rows]
    df = spark.createDataFrame(rows, "score double, amount double, id int")
    whole = {r["id"]: r["running_total"] for r in budgets.running_budget(df, "score", "amount").collect()}
    totals, total = {}, Fraction(0)
    for s, group in groupby(sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0))), key=lambda r: r[0]):
        totals[s] = total = total + sum(Fraction(r[1]) for r in group)
    assert all(whole[i] == pytest.approx(float(totals[s]), rel=1e-15) for s, _, i in rows)
    for limit in sorted(whole.values())[90::100 if seed else 200]:
        want = {i: t for i, t in whole.items() if t <= limit}
        for way, parts in ways:
            found = budgets.running_budget(df.repartition(parts), "score", "amount", limit=limit, one_task_rows=way)
            assert {r["id"]: r["running_total"] for r in found.collect()} == want
        kept = budgets.take_within_budget(df.repartition(4), "score", "amount", limit, ["id"])
        total, want = Fraction(0), set()
        for s, a, i in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2])):
            total += Fraction(a)
            if float(total) > limit:
                break
            want.add(i)
        assert {r["id"] for r in kept.collect()} == want


def test_three_tenths(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.1), (1, 0.1)], "score int, amount double")
    whole = budgets.running_budget(df, "score", "amount").collect()
    assert {r["running_total"] for r in whole} == {float(3 * Fraction(0.1))}
    for limit in (0.3, float(3 * Fraction(0.1))):
        kept = budgets.running_budget(df, "score", "amount", limit=limit).count()
        assert kept == sum(r["running_total"] <= limit for r in whole)


def test_decimals_stay_decimals_and_endless_amounts_are_refused(spark):
    df = spark.createDataFrame([(2, Decimal("0.10")), (1, Decimal("0.20")), (0, Decimal("0.01"))], "s int, a decimal(9,2)")
    found = budgets.running_budget(df, "s", "a", limit=Decimal("0.30")).collect()
    assert sorted(r["running_total"] for r in found) == [Decimal("0.10"), Decimal("0.30")]
    assert budgets.take_within_budget(df, "s", "a", Decimal("0.30"), ["s"]).count() == 2
    for bad in (float("inf"), float("nan")):
        with pytest.raises(ValueError, match="finite"):
            budgets.running_budget(spark.createDataFrame([(1, bad)], "s int, a double"), "s", "a", limit=1)

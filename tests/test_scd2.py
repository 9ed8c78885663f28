import random
from datetime import date, timedelta

import pytest

from barlake.operators import scd2, surrogate
from barlake.operators.surrogate import dense_ids
from barlake.schemas import DIM_TICKER, ddl
from barlake.session import store

OPEN = date(9999, 12, 31)
DAY1, DAY2 = date(2026, 1, 1), date(2026, 2, 1)
INCOMING = "symbol string, company_name string, currency string, source string"


def attrs(spark, *rows):
    return spark.createDataFrame(list(rows), INCOMING)


def stored(spark, frame):
    """The frame's rows without its plan."""
    return spark.createDataFrame(frame.collect(), ddl(DIM_TICKER))


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: r[0])


@pytest.fixture
def base(spark):
    first = attrs(spark, ("B", "Bee", "USD", "x"), ("A", "Ay", "USD", "x"), ("C", None, "USD", "x"))
    return stored(spark, scd2.initial(first, "2026-01-01"))


def test_first_load_opens_every_ticker(base):
    assert rows_of(base) == [
        (1, "A", "Ay", "USD", "x", DAY1, OPEN, True),
        (2, "B", "Bee", "USD", "x", DAY1, OPEN, True),
        (3, "C", None, "USD", "x", DAY1, OPEN, True),
    ]


def test_same_attributes_change_nothing(spark, base):
    again = attrs(spark, ("A", "Ay", "USD", "x"), ("B", "Bee", "USD", "x"), ("C", None, "USD", "x"))
    assert rows_of(scd2.merge(base, again, "2026-02-01")) == rows_of(base)


def test_change_new_and_absent_symbols(spark, base):
    incoming = attrs(spark, ("A", "Ay", "EUR", "x"), ("D", "Dee", "USD", "x"), ("AA", None, "USD", "x"))
    assert rows_of(scd2.merge(base, incoming, "2026-02-01")) == [
        (1, "A", "Ay", "USD", "x", DAY1, DAY2, False),
        (2, "B", "Bee", "USD", "x", DAY1, OPEN, True),
        (3, "C", None, "USD", "x", DAY1, OPEN, True),
        (4, "A", "Ay", "EUR", "x", DAY2, OPEN, True),
        (5, "AA", None, "USD", "x", DAY2, OPEN, True),
        (6, "D", "Dee", "USD", "x", DAY2, OPEN, True),
    ]


@pytest.mark.parametrize("symbol, before, after", [("C", None, "See"), ("A", "Ay", None)])
def test_null_and_value_differ(spark, base, symbol, before, after):
    merged = scd2.merge(base, attrs(spark, (symbol, after, "USD", "x")), "2026-02-01")
    versions = [r for r in rows_of(merged) if r[1] == symbol]
    assert [(r[2], r[7]) for r in versions] == [(before, False), (after, True)]


def test_second_change_on_one_day_keeps_an_empty_interval(spark, base):
    once = stored(spark, scd2.merge(base, attrs(spark, ("A", "Ay", "EUR", "x")), "2026-02-01"))
    twice = scd2.merge(once, attrs(spark, ("A", "Ay", "CHF", "x")), "2026-02-01")
    versions = [r for r in rows_of(twice) if r[1] == "A"]
    assert [(r[0], r[3], r[5], r[6], r[7]) for r in versions] == [
        (1, "USD", DAY1, DAY2, False), (4, "EUR", DAY2, DAY2, False), (5, "CHF", DAY2, OPEN, True),
    ]
    assert scd2.violations(twice).count() == 0


def test_closed_history_is_kept(spark, base):
    once = stored(spark, scd2.merge(base, attrs(spark, ("A", "Ay", "EUR", "x")), "2026-02-01"))
    back = scd2.merge(once, attrs(spark, ("A", "Ay", "USD", "x")), "2026-03-01")
    assert [r[0] for r in rows_of(back)] == [1, 2, 3, 4, 5]
    assert rows_of(back)[0] == (1, "A", "Ay", "USD", "x", DAY1, DAY2, False)


def test_empty_dimension_and_empty_incoming(spark, base):
    empty = spark.createDataFrame([], ddl(DIM_TICKER))
    incoming = attrs(spark, ("A", "Ay", "USD", "x"))
    assert rows_of(scd2.merge(empty, incoming, "2026-01-01")) == rows_of(scd2.initial(incoming, "2026-01-01"))
    assert rows_of(scd2.merge(base, attrs(spark), "2026-02-01")) == rows_of(base)


def test_violations_are_found(spark):
    dim = spark.createDataFrame(
        [
            (1, "A", "n", "c", "s", DAY1, OPEN, True), (2, "A", "n", "c", "s", DAY2, OPEN, True),
            (3, "B", "n", "c", "s", DAY1, date(2026, 3, 1), False), (4, "B", "n", "c", "s", DAY2, OPEN, True),
            (5, "C", "n", "c", "s", DAY1, DAY2, False), (6, "C", "n", "c", "s", DAY2, OPEN, True),
        ],
        ddl(DIM_TICKER),
    )
    assert {tuple(r) for r in scd2.violations(dim).collect()} == {("A", 2, 1), ("B", 1, 1)}


def test_types_are_those_of_the_schema(spark, base):
    expected = list(DIM_TICKER.items())
    incoming = attrs(spark, ("A", "Ay", "EUR", "x"))
    assert scd2.initial(incoming).dtypes == expected
    assert scd2.merge(base, incoming).dtypes == expected


@pytest.mark.parametrize("count, range_rows", [(0, 64), (1, 64), (5, 2), (3000, 7), (3000, 640), (3000, 10**6)])
def test_dense_ids_equal_a_global_row_number(spark, count, range_rows):
    rng = random.Random(count + range_rows)
    keys = {f"SAMEPREFIX{rng.randrange(10**6):07d}" for _ in range(count)}
    frame = spark.createDataFrame([(k,) for k in keys], "symbol string").repartition(4)
    got = {r.symbol: r.id for r in dense_ids(frame, "symbol", "id", 10, range_rows).collect()}
    assert got == {k: 11 + i for i, k in enumerate(sorted(keys))}


def test_ranges_grow_with_the_keys(spark):
    """About as many keys to a range, whatever their number: no task sorts a fixed share of all keys."""
    for count, ranges in ((900, 1), (5_000, 5), (40_000, 40)):
        assert surrogate.range_count(count, 1_000) == ranges
        keys = spark.range(count).selectExpr("concat('SAMEPREFIX', lpad(id * 7919 % 1000003, 9, '0')) AS symbol")
        sizes = [r["count"] for r in surrogate.laid_out(keys, ["symbol"], ranges).groupBy("_range").count().collect()]
        assert len(sizes) == ranges and max(sizes) < 2_000
    assert surrogate.range_count(0) == 1 and surrogate.range_count(10**12) == 10**6


@pytest.mark.parametrize("group", [1, 3, 1024])
def test_sums_in_two_levels(spark, group):
    rng = random.Random(group)
    rows = [(i, rng.randrange(100)) for i in range(40) if i % 7]
    got = surrogate.sums_below(spark.createDataFrame(rows, "place bigint, n bigint"), "place", "n", "below", group)
    assert {(r.place, r.n, r.below) for r in got.collect()} == {(i, n, sum(m for j, m in rows if j < i)) for i, n in rows}


def test_keys_of_several_columns(spark):
    rows = [(random.Random(i).randrange(9), f"k{i}") for i in range(200)]
    frame = spark.createDataFrame(rows, "day int, symbol string").repartition(3)
    got = {(r.day, r.symbol): r.id for r in dense_ids(frame, ["day", "symbol"], "id", range_rows=17).collect()}
    assert got == {k: i for i, k in enumerate(sorted(rows), 1)}


def test_numbering_never_sorts_everything_in_one_task(spark, plan_of, base):
    """What is left to run reads stored ranges; only their sizes, one row each, meet in a window."""
    merged = scd2.merge(base, attrs(spark, ("A", "Ay", "EUR", "x")), "2026-02-01")
    executed = plan_of(merged)
    windows = [line for line in executed.splitlines() if "Window [" in line]
    assert windows and all("sum(_size" in line or "sum(_n" in line for line in windows)
    assert "CartesianProduct" not in executed and "NestedLoop" not in executed


def test_a_merge_joins_once(spark, monkeypatch, plan_of, base):
    """The joined pairs are stored; kept and numbered rows come from there."""
    plans = []

    def stored_once(frame):
        plans.append(plan_of(frame))
        return store(frame)

    monkeypatch.setattr(scd2, "store", stored_once)
    merged = scd2.merge(base, attrs(spark, ("A", "Ay", "EUR", "x")), "2026-02-01")
    assert [p.count("FullOuter") for p in plans] == [1] and "Join" in plans[0]
    assert "FullOuter" not in plan_of(merged)


OBSERVED = "symbol string, company_name string, currency string, source string, date date"


def plain(dim):
    """Versions without their keys."""
    return sorted((tuple(r)[1:] for r in dim.collect()), key=str)


def in_order(spark, loads):
    """The dimension that loads in the order of their days leave, by ``initial`` and ``merge``."""
    dim = None
    for day in sorted(loads):
        frame = attrs(spark, *[(s, *a) for s, a in loads[day].items()])
        dim = stored(spark, scd2.initial(frame, str(day)) if dim is None else scd2.merge(dim, frame, str(day)))
    return dim


def random_loads(seed, days, symbols=25):
    rng = random.Random(seed)
    return {
        date(2026, 1, 1) + timedelta(days=3 * d): {
            f"S{i}": (rng.choice([None, "n"]), rng.choice(["USD", "EUR"]), "x") for i in range(symbols) if rng.random() < 0.6
        }
        for d in range(days)
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_loads_in_order(spark, seed):
    loads = random_loads(seed, 4)
    seen = [(s, *a, day) for day, some in loads.items() for s, a in some.items()]
    found = scd2.history(spark.createDataFrame(seen, OBSERVED).repartition(4))
    assert rows_of(found) == rows_of(in_order(spark, loads))
    assert found.dtypes == list(DIM_TICKER.items()) and scd2.violations(found).count() == 0
    assert scd2.history(spark.createDataFrame([], OBSERVED)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_any_order_equal_the_history(spark, seed):
    """Late, repeated and replaced loads leave what one pass over all of them finds, and keys stay with days."""
    loads, rng = random_loads(seed, 4), random.Random(seed)
    days = list(loads)
    rng.shuffle(days)
    sequence = [(day, loads[day]) for day in days]
    sequence.insert(3, sequence[1])  # once more
    replaced = {s: ("other", "CHF", "y") for s in loads[days[0]]}
    sequence.insert(2, (days[0], replaced))  # replaced, and later put right again
    sequence.append((days[0], loads[days[0]]))
    dim, done = None, {}
    for day, some in sequence:
        frame = attrs(spark, *[(s, *a) for s, a in some.items()])
        log = spark.createDataFrame([(s, d) for d, o in done.items() for s in o], "symbol string, load_date date")
        before = dim
        dim = stored(spark, scd2.initial(frame, str(day)) if dim is None else scd2.merge_late(dim, frame, log, str(day)))
        done[day] = some
        seen = [(s, *a, d) for d, others in done.items() for s, a in others.items()]
        assert plain(dim) == plain(scd2.history(spark.createDataFrame(seen, OBSERVED)))
        keys = [r.ticker_key for r in dim.collect()]
        assert len(keys) == len(set(keys))
        if before is not None:  # a version whose first day is still there has its key still
            old = {(r.symbol, r.effective_from): r.ticker_key for r in before.collect()}
            now = {(r.symbol, r.effective_from): r.ticker_key for r in dim.collect()}
            assert all(now[k] == old[k] for k in old.keys() & now.keys())
    assert scd2.violations(dim).count() == 0


def test_merge_between_cuts_and_joins(spark):
    def v(key, start, end, source):
        return (key, "A", None, "USD", source, start, end, end == OPEN)

    d = [date(2026, 1, i) for i in range(1, 30)]
    dim = spark.createDataFrame(
        [v(1, d[1], d[10], "x"), v(2, d[10], d[10], "y"), v(3, d[10], d[20], "z"), v(4, d[20], OPEN, "x"),
         (5, "B", None, "USD", "x", d[1], OPEN, True)], ddl(DIM_TICKER),
    )

    def merged(source, start, end):
        new = spark.createDataFrame([("A", None, "USD", source, start, end)], (
            "symbol string, company_name string, currency string, source string, valid_from date, valid_to date"))
        rows = rows_of(scd2.merge_between(dim, new))
        assert (5, "B", None, "USD", "x", d[1], OPEN, True) in rows
        return [(r[0], r[4], r[5], r[6]) for r in sorted(rows, key=lambda r: (r[5], r[6])) if r[1] == "A"]

    rest = [(2, "y", d[10], d[10]), (3, "z", d[10], d[20]), (4, "x", d[20], OPEN)]
    assert merged("n", d[3], d[5]) == [(1, "x", d[1], d[3]), (6, "n", d[3], d[5]), (7, "x", d[5], d[10]), *rest]
    assert merged("n", d[0], d[2]) == [(6, "n", d[0], d[2]), (1, "x", d[2], d[10]), *rest]
    assert merged("n", d[1], d[2]) == [(1, "n", d[1], d[2]), (6, "x", d[2], d[10]), *rest]
    assert merged("x", d[0], d[2]) == [(1, "x", d[0], d[10]), *rest]  # grows to the left
    assert merged("x", d[12], OPEN) == [(1, "x", d[1], d[10]), rest[0], (3, "z", d[10], d[12]), (6, "x", d[12], OPEN)]
    assert merged("n", d[5], d[25]) == [(1, "x", d[1], d[5]), (6, "n", d[5], d[25]), (4, "x", d[25], OPEN)]
    assert merged("x", d[5], d[20]) == [(1, "x", d[1], OPEN)]
    assert merged("z", d[10], d[20]) == [(1, "x", d[1], d[10]), *rest[1:]]

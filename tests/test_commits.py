"""Commits of several writers, old versions, lasting keys and signed changes."""

from __future__ import annotations

import datetime as dt
import random
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plans import physical
from stratoform.operators.keys import MOST_FOLDERS, KeyRegistry
from stratoform.plans import gold, summaries
from stratoform.session import put_if_absent, read_small
from stratoform.sources.changes import KeyedTable
from stratoform.sources.commits import CommitLog, Entry

T, D = dt.datetime, dt.date
CHANGES = "key int, at timestamp, v string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def changes(spark, *data):
    return spark.createDataFrame([(k, T(2024, 1, day), v) for k, day, v in data], CHANGES)


# --- the log ---------------------------------------------------------------


def test_a_name_is_taken_once(spark, tmp_path):
    path = f"file://{tmp_path}/log/1.commit"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, f"writer {i} " + "x" * 5000), range(24)))
    assert won.count(True) == 1
    assert read_small(spark, path) == f"writer {won.index(True)} " + "x" * 5000
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == ["1.commit"]


def test_many_writers_all_count_and_the_log_stays_short(spark, tmp_path):
    log = CommitLog(f"file://{tmp_path}/t", kept=5)
    writers, each = 6, 12

    def write(w):
        for i in range(each):
            log.commit(spark, lambda state: Entry(0, "delta", f"{w}-{i}", until=state.version), tries=1000)

    with ThreadPoolExecutor(writers) as pool:
        list(pool.map(write, range(writers)))
    state = log.state(spark)
    assert state.version == writers * each - 1
    assert sorted(e.folder for e in state.changes) == sorted(f"{w}-{i}" for w in range(writers) for i in range(each))
    # Each was made from the state just before it, and a writer's commits are in its order.
    assert all(e.until == e.version - 1 for e in state.changes)
    for w in range(writers):
        assert [e.folder for e in state.changes if e.folder.startswith(f"{w}-")] == [f"{w}-{i}" for i in range(each)]
    assert len([p for p in (tmp_path / "t" / "_log").iterdir() if not p.name.endswith(".crc")]) <= 5 + 2 * 10 + 3


def test_a_thousand_loads_keep_a_bounded_number_of_files(spark, tmp_path):
    log = CommitLog(f"file://{tmp_path}/t", kept=3)
    most = 0
    for i in range(1000):
        if i % 7 == 0:
            log.commit(spark, lambda state: Entry(0, "base", f"base-{i}", state.version))  # noqa: B023
        else:
            log.commit(spark, lambda state: Entry(0, "delta", f"delta-{i}"))  # noqa: B023
        if i % 7:
            (tmp_path / "t" / f"delta-{i}").mkdir()
        most = max(most, len([p for p in (tmp_path / "t" / "_log").iterdir() if not p.name.endswith(".crc")]))
    assert log.state(spark).version == 999 and most <= 30
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("delta")]) <= 25
    assert list(log.versions(spark))[-1] == 999
    for v in list(log.versions(spark))[-3:]:
        assert log.state(spark, v).version == v


def test_versions_that_are_gone_are_refused(spark, tmp_path):
    log = CommitLog(f"file://{tmp_path}/t", kept=2, snapshot_every=4)
    for i in range(20):
        log.commit(spark, lambda state: Entry(0, "delta", f"d{i}"))  # noqa: B023
    with pytest.raises(ValueError):
        log.state(spark, 2)
    with pytest.raises(ValueError):
        log.state(spark, 20)
    with pytest.raises(ValueError):
        log.entries(spark, 0, 19)
    assert [e.folder for e in log.state(spark, 18).changes] == [f"d{i}" for i in range(19)]


# --- keyed tables ----------------------------------------------------------


def keyed(path, **options):
    return KeyedTable(f"file://{path}", ("key",), ("at",), **options)


def test_two_writers_from_one_state_both_count(spark, tmp_path):
    target = keyed(tmp_path / "t", max_deltas=3, kept=50)
    target.replace(changes(spark, (0, 1, "first")))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: target.upsert(changes(spark, (k, 1, f"v{k}"), (0, k + 1, f"w{k}"))), range(1, 13)))
    assert rows(target.read(spark), "key", "v") == sorted([(0, "w12"), *((k, f"v{k}") for k in range(1, 13))], key=repr)


def test_changes_during_a_compaction_stay(spark, tmp_path, monkeypatch):
    target = keyed(tmp_path / "t")
    target.replace(changes(spark, (1, 1, "a"), (2, 1, "b")))
    target.upsert(changes(spark, (2, 2, "b2")))
    read = KeyedTable._rows

    def late(self, session, state):
        found = read(self, session, state)
        monkeypatch.setattr(KeyedTable, "_rows", read)
        target.upsert(changes(spark, (3, 1, "c"), (1, 3, "a3")))
        return found

    monkeypatch.setattr(KeyedTable, "_rows", late)
    target.compact(spark)
    assert [e.kind for e in target.log.state(spark).changes] == ["delta"]
    assert rows(target.read(spark), "key", "v") == [(1, "a3"), (2, "b2"), (3, "c")]
    # A full load that comes first makes the compaction void.
    monkeypatch.setattr(KeyedTable, "_rows", lambda self, s, state: (monkeypatch.setattr(KeyedTable, "_rows", read), target.replace(changes(spark, (9, 1, "z"))), read(self, s, state))[2])
    target.compact(spark)
    assert rows(target.read(spark), "key", "v") == [(9, "z")]


def test_old_versions_and_deleted_rows(spark, tmp_path):
    target = keyed(tmp_path / "t", kept=20)
    target.replace(changes(spark, (1, 1, "a"), (2, 1, "b"), (3, 1, "c")))
    target.upsert(changes(spark, (2, 2, "b2"), (4, 1, "d")))
    target.delete(spark.createDataFrame([(1,), (2,), (77,)], "key int"))
    target.upsert(changes(spark, (2, 1, "back"), (3, 0 + 2, "c2")))
    states = [
        [(1, "a"), (2, "b"), (3, "c")],
        [(1, "a"), (2, "b2"), (3, "c"), (4, "d")],
        [(3, "c"), (4, "d")],
        [(2, "back"), (3, "c2"), (4, "d")],
    ]
    for _ in range(2):
        for version, expected in enumerate(states):
            assert rows(target.read(spark, version), "key", "v") == expected
        target.compact(spark)
    assert rows(target.read(spark), "key", "v") == states[-1]
    signed = lambda a, b: rows(target.changes_between(spark, a, b), "key", "v", "weight")
    assert signed(0, 1) == [(2, "b", -1), (2, "b2", 1), (4, "d", 1)]
    assert signed(1, 2) == [(1, "a", -1), (2, "b2", -1)]
    assert signed(0, 3) == sorted([(1, "a", -1), (2, "b", -1), (2, "back", 1), (3, "c", -1), (3, "c2", 1), (4, "d", 1)], key=repr)
    assert signed(3, 5) == [] and signed(2, 2) == []
    target.replace(changes(spark, (3, 2, "c2"), (5, 1, "e")))
    assert signed(5, 6) == sorted([(2, "back", -1), (4, "d", -1), (5, "e", 1)], key=repr)


def test_merged_rows_equal_the_newest_of_each_key(spark, tmp_path):
    """Ties and nulls in the order, as ``latest_per_key`` has them; the table is scanned once whole."""
    rng = random.Random(1)
    at = lambda: rng.choice([None, T(2024, 1, 1), T(2024, 1, 2), T(2024, 1, 3)])
    data = lambda keys: [(k, at(), rng.choice([None, "a", "b", "c"])) for k in keys]
    base = data([None, *range(60)])
    first, second = data([rng.choice([None, *range(80)]) for _ in range(70)]), data([rng.choice([None, *range(80)]) for _ in range(70)])
    target = keyed(tmp_path / "t")
    for write, part in ((target.replace, base), (target.upsert, first), (target.upsert, second)):
        write(spark.createDataFrame(part, CHANGES))
    best = {}
    for k, t, v in base + first + second:
        rank = (t is not None, t or T.min, v is not None, [-ord(c) for c in v or ""])
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v))
    assert rows(target.read(spark)) == sorted((r for _, r in best.values()), key=repr)


@pytest.mark.parametrize("few", [0, 10**9])
def test_changes_equal_the_difference_of_the_versions(spark, tmp_path, monkeypatch, few):
    """Between any two versions, with ties, nulls, deleted keys that come back, and a merged base."""
    monkeypatch.setattr("stratoform.sources.changes.FEW", few)
    rng = random.Random(2)
    at = lambda: rng.choice([None, T(2024, 1, 1), T(2024, 1, 2)])
    data = lambda n: spark.createDataFrame([(rng.choice([None, *range(20)]), at(), rng.choice([None, "a", "b"])) for _ in range(n)], CHANGES)
    target = keyed(tmp_path / "t", kept=20)
    target.replace(data(25))
    for write in (target.upsert, target.delete, target.upsert, target.upsert, target.delete):
        write(data(8))
    target.compact(spark)
    target.upsert(data(8))
    versions = [Counter(map(tuple, target.read(spark, v).select("key", "at", "v").collect())) for v in range(8)]
    for a, b in ((0, 1), (0, 2), (1, 4), (2, 5), (3, 7), (5, 6), (6, 7), (0, 7)):
        signed = {tuple(r[:3]): r[3] for r in target.changes_between(spark, a, b).select("key", "at", "v", "weight").collect()}
        change = {k: versions[b][k] - versions[a][k] for k in versions[a] | versions[b]}
        assert signed == {k: n for k, n in change.items() if n}


def test_changes_meet_in_one_shuffle(spark, tmp_path):
    target = keyed(tmp_path / "t")
    target.replace(changes(spark, (1, 1, "a"), (2, 1, "b"), (3, 1, "c")))
    target.upsert(changes(spark, (2, 2, "b2"), (4, 2, "d")))
    target.delete(changes(spark, (1, 1, "a")))
    assert physical(target.changes_between(spark, 0, 2)).count("Exchange ") == 1


@pytest.mark.parametrize("members", [summaries.signed_day_members, summaries.signed_customer_members])
def test_members_take_one_pass_over_the_sales(spark, members):
    sales = spark.createDataFrame([(1, 1, 1, 10, D(2024, 1, 1), 2, Decimal("5.00"), Decimal("10.0000"), 1)], SALES)
    buyers = spark.createDataFrame([(1, 7)], "sale_id int, customer_id int")
    joined = sales.drop("customer_id").join(buyers, "sale_id")
    assert physical(members(joined)).count("Join ") == 1
    assert [r.net for r in members(joined).collect()] == 2 * [Decimal("10.0000")]


# --- lasting keys ----------------------------------------------------------


def registry(path):
    return KeyRegistry(f"file://{path}", ("id",), "key")


def members(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id int, name string")


def test_old_members_keep_their_keys(spark, tmp_path):
    keys = registry(tmp_path / "k")
    assert keys.read(spark) is None and rows(keys.keyed(members(spark, 1)), "key") == [(None,)]
    assert keys.assign(members(spark, 30, 10, 20, 10)) == 3
    assert rows(keys.read(spark)) == [(10, 1), (20, 2), (30, 3)]
    # Before, between and after the old ones, and one without an id.
    assert keys.assign(members(spark, 5, 10, 15, 20, 30, 40, None)) == 4
    expected = sorted([(10, 1), (20, 2), (30, 3), (None, 4), (5, 5), (15, 6), (40, 7)], key=repr)
    assert rows(keys.read(spark)) == expected
    for _ in range(2):
        assert keys.assign(members(spark, 5, 15, None)) == 0
        assert keys.assign(members(spark)) == 0
    assert rows(keys.read(spark)) == expected
    assert rows(keys.keyed(members(spark, 15, 99)), "key", "id", "name") == [(6, 15, "n15"), (None, 99, "n99")]


def test_new_members_are_in_the_callers_order(spark, tmp_path):
    keys = registry(tmp_path / "k")
    df = spark.createDataFrame([(1, "c"), (2, "a"), (3, "b"), (1, "z"), (4, None)], "id int, name string")
    keys.assign(df, ["name"])
    assert rows(keys.read(spark)) == [(1, 4), (2, 2), (3, 3), (4, 1)]


def test_concurrent_assignments_give_each_member_one_key(spark, tmp_path):
    keys = registry(tmp_path / "k")
    sets = [range(0, 60), range(30, 90), range(50, 120), range(0, 120, 7)]
    with ThreadPoolExecutor(4) as pool:
        added = list(pool.map(lambda ids: keys.assign(members(spark, *ids)), sets))
    found = rows(keys.read(spark))
    assert sum(added) == 120
    assert sorted(i for i, _ in found) == list(range(120)) and sorted(k for _, k in found) == list(range(1, 121))


def test_many_assignments_leave_few_folders(spark, tmp_path):
    keys = registry(tmp_path / "k")
    keys.assign(members(spark, *range(500)))
    for i in range(16):
        keys.assign(members(spark, 1000 + i))
    state = keys.log.state(spark)
    assert len(state.changes) <= MOST_FOLDERS and state.base.kind == "merged"
    assert rows(keys.read(spark)) == sorted([*((i, i + 1) for i in range(500)), *((1000 + i, 501 + i) for i in range(16))], key=repr)


def test_facts_loaded_before_point_to_the_same_members(spark, tmp_path):
    keys = gold.GoldKeys(f"file://{tmp_path}/keys")
    customers = lambda *ids: spark.createDataFrame([(i, f"AW{i}", D(2024, 1, 1)) for i in ids], "cst_id int, cst_key string, cst_create_date date")
    products = lambda *ids: spark.createDataFrame([(i, D(2024, 1, i), f"P{i}") for i in ids], "prd_id int, prd_start_dt date, prd_key string")
    first = {"crm_cust_info": customers(7, 9), "crm_prd_info": products(5, 6)}
    assert keys.assign(first) == {"dim_customers": 2, "dim_products": 2}
    before = rows(keys.customers.read(spark)), rows(keys.products.read(spark))
    second = {"crm_cust_info": customers(1, 7, 8, 9, 10), "crm_prd_info": products(1, 5, 6, 8)}
    assert keys.assign(second) == {"dim_customers": 3, "dim_products": 2}
    assert keys.assign(second) == {"dim_customers": 0, "dim_products": 0}
    after = rows(keys.customers.read(spark)), rows(keys.products.read(spark))
    assert set(before[0]) <= set(after[0]) and set(before[1]) <= set(after[1])


# --- signed changes in summaries -------------------------------------------

SALES = """sale_id int, line_number int, customer_id int, product_id int, sale_date date, quantity bigint,
           unit_price decimal(10,2), net_amount decimal(12,4), at int"""


@pytest.mark.parametrize("name", sorted(summaries.summaries()))
def test_corrected_and_deleted_sales(spark, tmp_path, name):
    rng = random.Random(3)

    def sale(i, at):
        return (
            i, i % 3, rng.choice([None, 1, 2, 3, 9]), rng.randrange(10, 14), rng.choice([None, D(2024, 1, rng.randrange(1, 6))]),
            rng.choice([None, 1, 2]), rng.choice([None, Decimal("5.25"), Decimal("7.00")]), rng.choice([None, Decimal("10.5000"), Decimal("-3.1000")]), at,
        )

    table = KeyedTable(f"file://{tmp_path}/sales", ("sale_id", "line_number"), ("at",), max_deltas=2, kept=20)
    table.replace(spark.createDataFrame([sale(i, 1) for i in range(60)], SALES))
    customers = spark.createDataFrame([(i, f"c{i}", "NY", "F") for i in (1, 2, 3, 4)], "customer_id int, customer_name string, region string, gender string")
    products = spark.createDataFrame([(i, f"p{i}", "Acc", Decimal("5.00")) for i in range(10, 15)], "product_id int, product_name string, category_name string, list_price decimal(10,2)")
    inputs = lambda sales: {"sales": sales, "customers": customers, "products": products}
    summary = replace(summaries.summaries()[name], name=f"{name}_{uuid.uuid4().hex}")
    store = summaries.SummaryStore(spark, f"file://{tmp_path}/store")
    store.create(summary, inputs(table.read(spark)))
    seen = table.version(spark)
    for at in (2, 3):
        table.upsert(spark.createDataFrame([sale(i, at) for i in rng.sample(range(70), 25)], SALES))
        table.delete(table.read(spark).where(F.col("sale_id").isin(rng.sample(range(70), 12))))
        now = table.version(spark)
        for _ in range(2):
            store.refresh_incremental(summary.name, inputs(table.changes_between(spark, seen, now)), f"{seen}-{now}")
            whole = summary.build(inputs(table.read(spark)))
            assert rows(store.read(summary.name)) == rows(whole)
        seen = now
    table.delete(table.read(spark))
    now = table.version(spark)
    store.refresh_incremental(summary.name, inputs(table.changes_between(spark, seen, now)), "all")
    assert rows(store.read(summary.name)) == rows(summary.build(inputs(table.read(spark))))


def test_a_refresh_reads_no_old_sales(spark, tmp_path):
    summary = replace(summaries.summaries()["mv_daily_sales"], name=f"daily_{uuid.uuid4().hex}")
    store = summaries.SummaryStore(spark, f"file://{tmp_path}/store")
    sale = (1, 1, 1, 10, D(2024, 1, 1), 2, Decimal("5.00"), Decimal("10.0000"), 1)
    spark.createDataFrame([sale], SALES).write.parquet(f"file://{tmp_path}/old")
    store.create(summary, {"sales": spark.read.parquet(f"file://{tmp_path}/old")})
    import shutil

    shutil.rmtree(tmp_path / "old")
    back = spark.createDataFrame([(*sale, -1)], SALES + ", weight int")
    store.refresh_incremental(summary.name, {"sales": back}, "back")
    assert store.read(summary.name).count() == 0

"""The model of train_and_rank learns from every part of the feature row."""

import datetime

import pytest

from tackroom.plans.q_flows import model_rows, train_and_rank


@pytest.mark.parametrize("part", ["trainer", "career", "context"])
def test_model_learns_from_the_whole_row(spark, tmp_dir, part):
    """The place (1 or 2) hangs on one part of the row only: place 1 must get the higher chance on every row."""
    day = datetime.datetime(2020, 1, 1)
    orders, lines, first = [], [], {}
    for k in range(60):
        place = 1 + k % 2
        first[k] = place == 1
        # career: horse 1 has all orders of place 1, horses 2, 3, ... have one order each
        horse = (1 if place == 1 else 2 + k) if part == "career" else 2 + k
        trainer = place if part == "trainer" else 1
        won = ("R" if place == 1 else "N") if part == "trainer" else "N"
        orders.append((k, horse, "O", 100.0, day, f"P{place}" if part == "context" else "P"))
        lines.append((k, 1, trainer, place, 5.0, 1.0, 0.0, 0.05 if k % 3 else 0.0, won, "O", day))
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                           "o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                            "l_shipdate timestamp"),
        "customer": ([(i, f"c{i}", 1, 1.0, "S") for i in range(1, 62)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    got = {r.l_orderkey: r.win_prob for r in train_and_rank(spark, tmp_dir).collect()}
    assert len(got) == 60
    assert min(p for k, p in got.items() if first[k]) > max(p for k, p in got.items() if not first[k])


def test_lines_of_the_feature_rows_move_by_order_only(spark, tmp_dir):
    """Lines are not dealt out by trainer, and orders meet their horse before the lines meet their order."""
    day = datetime.datetime(2020, 1, 1)
    for name, rows, schema in (
            ("orders", [(1, 1, "O", 1.0, day, "P")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                                     "o_orderdate timestamp, o_orderpriority string"),
            ("lineitem", [(1, 1, 1, 1, 5.0, 1.0, 0.0, 0.0, "R", "O", day), (1, 1, None, 2, 5.0, 1.0, 0.0, 0.0, "N", "O", day)],
             "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
            ("customer", [(1, 1, "S")], "c_custkey long, c_nationkey int, c_mktsegment string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    rows = model_rows(spark, tmp_dir)
    plan = rows._jdf.queryExecution()
    assert "Exchange hashpartitioning(l_suppkey" not in plan.executedPlan().toString()
    todo, sides = [plan.optimizedPlan()], []
    while todo:
        node = todo.pop()
        kids = [node.children().apply(i) for i in range(node.children().size())]
        todo += kids
        if node.nodeName() == "Join" and {"o_custkey", "c_custkey"} <= {a.split("#")[0].strip("( ") for a in node.condition().get().toString().split("=")}:
            sides.append([kids[0].output().apply(i).name() for i in range(kids[0].output().size())])
    assert any("o_orderkey" in names for names in sides) and not any("l_linenumber" in names for names in sides)
    assert sorted((r.l_linenumber, r.trainer_freq, r.total_races) for r in rows.collect()) == [(1, 1, 1), (2, None, 1)]

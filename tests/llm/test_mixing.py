"""Mixing against a plain water-filling, and its edge cases."""

import pytest

from mortarline.llm.mixing import cycled_weights, mix, water_fill


def poured(sizes, weights, share, epochs):
    target, open_ = {}, {s for s in sizes if weights[s] > 0}
    total = share * sum(sizes.values())
    while open_:
        level = (total - sum(target.values())) / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= epochs * sizes[s]}
        if not full:
            return target | {s: level * weights[s] for s in open_}
        target |= {s: float(epochs * sizes[s]) for s in full}
        open_ -= full
    return target


@pytest.mark.parametrize("share", [0.3, 1.5, 1.99, 3.0])
def test_water_fill(spark, share):
    sizes = {"a": 900, "b": 40, "c": 60, "d": 0, "e": 500, "f": 7}
    weights = {"a": 1.0, "b": 5.0, "c": 2.0, "d": 5.0, "e": 3.0, "f": 1.0}
    rows = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, size long, weight double")
    got = {r["source"]: r["target"] for r in water_fill(rows, share, 2).collect()}
    assert got == pytest.approx(poured(sizes, weights, share, 2))


def docs(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    rows += [(7, "w " * 50, "hot"), (None, "a b", None), (None, None, None), (9001, "", "s1"), (9002, "x" * 9999, "s2")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_is_near_target_and_bounded(spark):
    table = docs(spark)
    rows = mix(table, cycled_weights(table, (5, 2, 1))).collect()
    assert len(rows) == table.count()
    by_source = {}
    for r in rows:
        assert 0 <= r["repeats"] <= 2 and r["taken"] == r["repeats"] * r["size"]
        by_source.setdefault(r["source"], [r["target"], 0, 0])
        by_source[r["source"]][1] += r["taken"]
        by_source[r["source"]][2] = max(by_source[r["source"]][2], r["size"])
    for target, taken, largest in by_source.values():
        assert abs(target - taken) <= largest
    assert sum(t for t, _, _ in by_source.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    again = mix(table.repartition(5), cycled_weights(table, (5, 2, 1)))
    key = lambda r: (str(r["id"]), r["size"], r["repeats"])
    assert sorted(map(key, rows)) == sorted(map(key, again.collect()))


def test_weights_cycle_by_code_point(spark):
    names = ["b", "a", "é", None, "Z", "", "ab", "b"]
    table = spark.createDataFrame([(n,) for n in names], "source string")
    got = {r["source"]: r["weight"] for r in cycled_weights(table, (5, 2, 1)).collect()}
    order = [*sorted({n for n in names if n is not None}), None]
    assert got == {n: (5.0, 2.0, 1.0)[i % 3] for i, n in enumerate(order)}


def test_empty(spark):
    table = docs(spark).where("false")
    assert mix(table, cycled_weights(table, (5, 2, 1))).count() == 0

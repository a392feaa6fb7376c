"""Sequential remapping against a simulation of folders and files."""

import random
from collections import Counter

import pytest

from pacewise.operators import remap
from pacewise.sinks.files import write_split
from tests.helpers import plan, rows

MAPPING = "seq int, route string, note string, target_route string"
SPLIT = "year int, pair_id string, date string, time string, vehicle_type string, travel_time_sec string, volume string"


def simulate(data, rules, keep_source):
    """Folders of yearly files; each rule moves or copies a folder, merging files that exist."""
    folders = {}
    for row in data:
        folders.setdefault(row[1], {}).setdefault(row[0], []).append(row[2:])
    for source, target in rules:
        if source == target or source not in folders:
            continue
        place = folders.setdefault(target, {})
        for year, content in folders[source].items():
            if year in place:
                place[year] = list(dict.fromkeys(place[year] + content))
            else:
                place[year] = list(content)
        if not keep_source:
            del folders[source]
    return Counter((y, p, *r) for p, years in folders.items() for y, content in years.items() for r in content)


def run(spark, data, rules, keep_source):
    mapping = spark.createDataFrame([(i, a, "合併", b) for i, (a, b) in enumerate(rules)], MAPPING)
    return rows(remap.merge_segments(spark.createDataFrame(data, SPLIT), remap.merge_rules(mapping), keep_source))


@pytest.mark.parametrize("keep_source", [False, True])
@pytest.mark.parametrize("seed", range(6))
def test_random_mappings(spark, seed, keep_source):
    rng = random.Random(seed)
    names = "ABCDE"
    rules = [(rng.choice(names), rng.choice(names)) for _ in range(rng.randint(1, 7))]
    data = [(rng.choice((2024, 2025)), rng.choice(names[: rng.randint(2, 5)]), "2024/1/1", "00:00", str(rng.randint(1, 2)),
             str(rng.randint(1, 2)), "1") for _ in range(60)]
    assert run(spark, data, rules, keep_source) == simulate(data, rules, keep_source)


ROW = ("2024/1/1", "00:00", "31", "60", "1")


@pytest.mark.parametrize(
    "rules, a, b",
    [
        ([("A", "B"), ("B", "C")], "C", "C"),
        ([("B", "C"), ("A", "B")], "B", "C"),
        ([("A", "A")], "A", "B"),
    ],
)
def test_golden_order(spark, rules, a, b):
    data = [(2024, "A", *ROW), (2025, "B", *ROW)]
    got = {year: pair for (year, pair, *_) in run(spark, data, rules, False)}
    assert got == {2024: a, 2025: b}


def test_note_decides(spark):
    mapping = spark.createDataFrame([(0, "A", "停用", "B"), (1, "C", None, "D"), (2, " E ", "已合併", " F")], MAPPING)
    assert [tuple(r) for r in remap.merge_rules(mapping).collect()] == [(2, "E", "F")]


def test_dedup_only_where_data_met(spark):
    data = [(2025, "A", *ROW), (2025, "B", *ROW), (2024, "A", *ROW), (2024, "A", *ROW)]
    assert run(spark, data, [("A", "B")], False) == Counter({(2025, "B", *ROW): 1, (2024, "B", *ROW): 2})


def test_no_rules_keeps_rows(spark):
    data = [(2024, "A", *ROW)] * 2
    mapping = spark.createDataFrame([], MAPPING)
    assert rows(remap.merge_segments(spark.createDataFrame(data, SPLIT), remap.merge_rules(mapping))) == Counter(data)


def test_long_chain(spark):
    rules = [(f"s{i}", f"s{i + 1}") for i in range(150)]
    got = run(spark, [(2024, "s0", *ROW)], rules, False)
    assert got == Counter({(2024, "s150", *ROW): 1})


def test_merged_files_are_chronological(spark, tmp_path):
    data = [(2024, "A", "2024/10/1", "00:05", "1", "1", "1"), (2024, "A", "x", "00:00", "1", "1", "1"),
            (2024, "A", "2024/9/30", "23:55", "1", "1", "1"), (2024, "B", "2024/9/2", "23:55", "1", "1", "1")]
    write_split(spark.createDataFrame(data, SPLIT), str(tmp_path / "m"), reset=True, sort_by=remap.chronological())
    (part,) = (tmp_path / "m/year=2024/pair_id=A").glob("*.csv")
    assert [line.split(",")[0] for line in part.read_text().splitlines()] == ["2024/9/30", "2024/10/1", "x"]


def test_mapping_columns_are_required(spark):
    with pytest.raises(ValueError, match="target_route"):
        remap.merge_rules(spark.sql("SELECT 1 AS seq, 'A' AS route, '' AS note"))


def test_a_hundred_thousand_rules(spark):
    """Chains of 1 to 1,000 rules, in seq order and shuffled, against a walk along each chain."""
    rng = random.Random(5)
    rules, chain = [], 0
    while len(rules) < 100_000:
        length = rng.randint(1, 1000)
        numbers = sorted(rng.sample(range(10**9), length)) if chain % 2 else rng.sample(range(10**9), length)
        rules += [(n, f"c{chain}_{i}", f"c{chain}_{i + 1}") for i, n in enumerate(numbers)]
        chain += 1
    frame = spark.createDataFrame(rules, "seq long, route string, target_route string")
    leaves = {a: (n, b) for n, a, b in rules}
    found = {r.origin: r.target_pair_id for r in remap.resolve_rules(frame).collect()}
    assert len(found) == len(leaves) + chain
    for origin in rng.sample(sorted(found), 3000):
        place, at = origin, -1
        while place in leaves and leaves[place][0] > at:
            at, place = leaves[place]
        assert found[origin] == place


def test_every_task_sees_few_rules(spark):
    """No aggregate gathers the rules in one row."""
    mapping = spark.createDataFrame([(i, f"r{i}", "合併", f"r{i + 1}") for i in range(5)], MAPPING)
    text = plan(remap.resolve_rules(remap.merge_rules(mapping)))
    assert "collect_list" not in text and "SinglePartition" not in text

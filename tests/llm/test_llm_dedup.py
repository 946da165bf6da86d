import hashlib
import re

import pytest

from oddlens.llm import exact_dedup
from oddlens.llm.exact_dedup import ContentTable, exact_groups

SCHEMA = "doc_id long, text string, kept string, n long"
ROWS = [
    (5, "a b c", "x", 1),
    (2, "ab c", "x", 1),
    (3, "a  b c", "x", None),
    (9, "a\tb\nc\r\x0b\x0c", "x", 1),
    (4, None, None, None),
    (6, "", "y", 2),
    (7, " \n", "y", 2),
    (8, "a b", "y", 2),
    (10, "x" * 300_000, "y", 2),
    (10, "x" * 300_000, "y", 2),
    (None, "null id", "y", 2),
    (11, "null  id", "y", 2),
    (None, "alone", None, None),
]


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        content = re.sub("[\x20\x09-\x0d]", "", text or "")
        groups.setdefault(content, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    found = []
    for content, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(content.encode()).hexdigest()
        found += [(m[3], members[0][3], len(members), k == 0, sha) for k, m in enumerate(members)]
    return sorted(found, key=str)


@pytest.mark.parametrize("table_mb", [96, 0.0001])
def test_groups_equal_brute_force_also_when_tables_spill(spark, table_mb):
    rows = ROWS + [(100 + i, f"text {i % 40}", "z", i) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = sorted(map(tuple, exact_groups(df, table_mb).drop("text_hash").collect()), key=str)
    assert found == brute(rows)


def test_empty_table(spark):
    assert exact_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_hashes_with_different_contents_stay_apart():
    table = ContentTable(8)
    for k in range(50):
        entry, at = table.find(7, b"%d" % k)
        assert entry == -1
        table.add(7, b"%d" % k, at)
    assert [table.find(7, b"%d" % k)[0] for k in range(50)] == list(range(50))
    assert exact_dedup._better((3, 1, 0), (3, 2, 0)) and exact_dedup._better((4, 9, 0), (3, 1, 0))

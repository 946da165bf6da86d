import duckdb
import pytest

from oddlens.llm.line_rules import judged
from oddlens.llm.queries import CHECKS, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    result = con.sql(CHECKS[name])
    assert sorted(result.columns) == columns
    expected = result.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert sorted(map(tuple, found.select(*columns).collect()), key=str) == sorted(expected, key=str)


def test_lines_of_many_texts_are_removed(spark):
    menu, own = "home  About\tus 17 contact", " ".join(f"word{k}" for k in range(60))
    rows = [(k, f"{menu.replace('17', str(10 + k))}\n{own} {k}", "a", "x") for k in range(6)]
    rows += [(10 + k, f"{menu}\nunlike {k} {own}", "b", "x") for k in range(5)]
    rows += [(20, own + "\n" + menu, "b", "x")] * 9  # equal texts count once
    rows += [(30, "\n".join([menu] * 20 + [own[:40]]), "a", "x"), (31, None, None, None), (32, "", "a", None), (33, "w " * 200, "a", None), (34, "v" * 200_000, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, t string").repartition(3)
    found = {}
    for r in judged(df, limit=6).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert all(found[k][0].removed_words == 5 and found[k][0].kept for k in range(6))
    assert all(found[10 + k][0].removed_words == 0 for k in range(5))
    assert len(found[20]) == 9 and all(r.removed_words == 0 and r.kept for r in found[20])
    assert found[30][0].removed_words == 100 and not found[30][0].kept
    assert found[31][0].base_failed and found[32][0].base_failed and found[31][0].n_words == 0
    assert found[33][0].n_repeat_words == 200 and found[33][0].base_failed
    assert found[34][0].word_chars == 200_000
    assert judged(df.limit(0)).collect() == []

import hashlib
import re

import duckdb
from frames import TEXTS, documents, empty

from tidemark.llm import dedup
from tidemark.llm.queries import SQL, op10_content_sort


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_query_equals_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = op10_content_sort(spark, sf_dir)
    columns = ", ".join(df.columns)
    expected = connection.execute(f"SELECT {columns} FROM ({SQL['op10_content_sort']})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(expected)


def test_awkward_rows_and_a_hot_text(spark):
    texts = TEXTS + [(100 + n, "one  text\tthat very many rows share") for n in range(300)]
    docs = documents(spark, texts)
    found = dedup.exact_duplicates(docs).collect()
    assert len(found) == len(texts)
    groups = {}
    for i, t in texts:
        groups.setdefault(normal(t), []).append(i)
    for r in found:
        content = normal(r.row.text)
        ids = [i for i in groups[content] if i is not None]
        assert r.keep_id == min(ids, default=None) and r.group_size == len(groups[content])
        assert r.text_sha256 == hashlib.sha256(content.encode()).hexdigest()
    assert sum(r.kept for r in found) == len(groups)
    assert dedup.drop_duplicates(docs).columns == docs.columns
    assert dedup.exact_duplicates(empty(spark)).count() == 0


def test_a_hot_text_in_shuffled_rows_with_repeated_identifiers(spark):
    docs = spark.range(6000).selectExpr(
        "if(id % 3 = 0, id % 40, id) doc_id", "if(id % 3 = 0, 'one  hot text', concat('text ', id % 900)) text"
    ).repartition(7)
    found = dedup.exact_duplicates(docs).collect()
    assert len(found) == 6000
    for text, size in {r.row.text: r.group_size for r in found}.items():
        group = [r for r in found if r.row.text == text]
        least = min(r.row.doc_id for r in group)
        assert len(group) == size and {r.keep_id for r in group} == {least}
        assert [r.row.doc_id for r in group if r.kept] == [least]

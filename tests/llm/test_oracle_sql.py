"""The SQL against brute force in Python, which the operators are held against too."""

import duckdb
import pandas as pd
import test_decontaminate
import test_minhash
import test_spans

from quern.llm import oracle


def run(sql, **tables):
    con = duckdb.connect()
    con.execute("SET threads = 1")
    for name, (rows, columns) in tables.items():
        con.register(name, pd.DataFrame(rows, columns=columns).astype({columns[0]: "int64"}))
    return sorted(map(tuple, con.execute(sql).fetchall()), key=str)


def test_spans_sql():
    docs = [x for x in test_spans.corpus(5) if x[0] is not None]
    table = (docs, ["doc_id", "text"])
    assert run(oracle.SUFFIX, documents=table) == sorted(((k, *v) for k, v in test_spans.by_bytes(docs).items()), key=str)
    assert run(oracle.SUBSTRING, documents=table) == sorted(((k, *v) for k, v in test_spans.by_words(docs).items()), key=str)


def test_minhash_sql():
    docs = test_minhash.corpus(3)
    assert run(oracle.MINHASH, documents=(docs, ["doc_id", "text"])) == sorted(test_minhash.brute(docs), key=str)


def test_decontaminate_sql():
    docs, items = test_decontaminate.tables(4)
    docs = docs[:-1]  # the SQL counts on unique ids
    assert run(oracle.DECONTAMINATE, documents=(docs, ["doc_id", "text"]), benchmark=(items, ["item_id", "text"])) == test_decontaminate.brute(docs, items)

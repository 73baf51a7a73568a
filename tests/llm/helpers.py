"""What the tests of the corpus operators share."""

import os

import duckdb

from conftest import SF_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=1, lang="en", sources=("s0", "s1", None)):
    """Documents of these texts with ids from `first` on."""
    rows = [(first + k, t, lang, sources[k % len(sources)], None if t is None else len(t)) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def table(spark, name):
    return spark.read.parquet(os.path.join(SF_DIR, f"{name}.parquet"))


def by_sql(sql, **frames):
    """Sorted rows of DuckDB SQL over these frames, columns in name order."""
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(f"{name}_arrow", frame.toArrow())
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_arrow")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)

"""Compare the registered queries with their SQL: python tests/check_oracle.py SF_DIR [names]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from sparkprep.plans.oracle import ORACLE  # noqa: E402
from sparkprep.plans.queries import QUERIES  # noqa: E402
from sparkprep.plans.staging import local_session  # noqa: E402


def connect(data_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(data_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def normal(rows, columns):
    """Rows as sorted tuples with the columns in order of name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, connection, data_dir: str, name: str) -> str:
    """Empty if the query and its SQL agree, else what differs."""
    df = QUERIES[name](spark, data_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    result = connection.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    want = normal(result.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {c[0]: str(c[1]) for c in result.description}
    wrong = {n: (t, types[n]) for n, t in df.dtypes if SQL_TYPES.get(t) != types[n]}
    if wrong:
        return f"types {wrong}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for a, b in zip(got, want):
        if [type(v) for v in a] != [type(v) for v in b]:
            return f"types of {a!r:.500} and {b!r:.500}"
        if repr(a) != repr(b) and a != b:
            return f"{a!r:.500} != {b!r:.500}"
    return ""


if __name__ == "__main__":
    data, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    session, database = local_session(), connect(data)
    session.sparkContext.setLogLevel("ERROR")
    for query in names:
        began = time.time()
        if query not in ORACLE:
            print(f"{query:26s} no SQL")
            continue
        try:
            problem = compare(session, database, data, query)
        except Exception as failure:
            problem = f"{type(failure).__name__}: {failure!s:.700}"
        print(f"{query:26s} {problem or 'ok'} ({time.time() - began:.1f}s)", flush=True)

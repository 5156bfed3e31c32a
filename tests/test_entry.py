import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

QUICK = ["channel_histogram", "channel_qc_flags", "label_overlap_iou", "roi_allocation", "channel_match", "radius_neighbours", "panel_problems", "resumable_blocks"]


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and all(callable(f) for f in queries.values())


def test_sources_keep_the_rules():
    root = Path(entry.__file__).parent
    for path in (root / "slideloom").rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text, path
        if "llm" not in path.parts:
            assert not re.search(r"slideloom\.llm|from slideloom import llm", text), path


def canonical(rows, columns):
    def value(v):
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted((tuple(value(r[c]) for c in columns) for r in rows), key=repr)


@pytest.mark.parametrize("name", QUICK)
def test_queries_match_their_sql(spark, folder, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = [dict(zip(names, r)) for r in found.fetchall()]
    assert sorted(names) == columns
    assert canonical([r.asDict() for r in df.collect()], columns) == canonical(want, columns)

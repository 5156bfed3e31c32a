import csv
import io
import random

from slideloom.operators import strict_load as S

SCHEMA = "rec_id bigint, sheet_file string, sheet_kind string, line_no int, record string, received_at timestamp, pieces string"
PANEL = "marker,aliases,role"
SAMPLES = "sample_id,image,species,panel"


def rows(kind, header, records, file="f"):
    lines = [header, *records]
    return [(k + 1, file, kind, k + 1, r, None, "clash") for k, r in enumerate(lines)]


def reasons(spark, kind, header, records):
    return {r.rec_id - 2: r.reason for r in S.rejected(spark.createDataFrame(rows(kind, header, records), SCHEMA)).collect()}


def test_reasons_in_order(spark):
    records = [
        "A,x;y,lineage", '"A","x,y",STATE\r', 'A,"say ""hi""", nuclear ', 'A"b,x,lineage', '"A,x,lineage', 'A,"x"y,lineage', "A,x", "A,x,y,lineage", "A,x,none", "A,x,",
        'A,"x, lineage', "A,x,exclude​", 'A,"line\nbreak",state', '"","",""', "", None,
    ]
    found = reasons(spark, "panel", PANEL, records)
    assert found == {3: "quoting", 4: "quoting", 5: "quoting", 6: "column_count", 7: "column_count", 8: "value", 9: "value", 10: "quoting", 11: "value", 13: "value", 14: "column_count", 15: "column_count"}


def test_sample_values(spark):
    records = ["S1,i,Human,p", "S 1,i,human,p", ",i,human,p", "S1,i,rat,p", " S2 ,i, canine ,p", "S/1,i,mouse,p", "S 1,i,mouse,p", '"S:1",i,mouse,p']
    assert reasons(spark, "samples", SAMPLES, records) == {k: "value" for k in (1, 2, 3, 5, 6, 7)}


def test_header_of_own_sheet_and_missing_header(spark):
    data = rows("panel", " ROLE , Marker \r", ["state,A", "A,state"], "x") + [(50, "y", "panel", 2, "A,b", None, "")]
    found = {r.rec_id: r.reason for r in S.rejected(spark.createDataFrame(data, SCHEMA)).collect()}
    assert found == {3: "value", 50: "column_count"}
    loaded = S.load_sheet(spark.createDataFrame(data, SCHEMA), "panel").collect()
    assert [(r.rec_id, r.marker, r.role, r.notes) for r in loaded] == [(2, "A", "state", "")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.rejected(empty).count() == 0 and S.load_sheet(empty, "samples").count() == 0


def strictly(record):
    """Fields of a record or None, sign by sign."""
    fields, i = [], 0
    while True:
        text = ""
        if i < len(record) and record[i] == '"':
            i += 1
            while True:
                if i >= len(record):
                    return None
                if record[i] == '"':
                    if record[i + 1 : i + 2] == '"':
                        text, i = text + '"', i + 2
                        continue
                    i += 1
                    break
                text, i = text + record[i], i + 1
            if i < len(record) and record[i] != ",":
                return None
        else:
            while i < len(record) and record[i] != ",":
                if record[i] == '"':
                    return None
                text, i = text + record[i], i + 1
        fields.append(text)
        if i >= len(record):
            return fields
        i += 1


def test_against_a_sign_by_sign_parser(spark):
    rnd = random.Random(5)
    records = ["".join(rnd.choice('ab",,"\x01\n') for _ in range(rnd.randrange(0, 12))) for _ in range(400)]
    for values in (["a,b", 'q"q', "x"], ["", "\n", '""']):
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(values)
        records.append(out.getvalue())
    df = spark.createDataFrame(rows("other", "h,i,j", records), SCHEMA)
    loaded = {r.rec_id - 2: list(r.fields) for r in S.strict_load(df).collect()}
    why = {r.rec_id - 2: r.reason for r in S.rejected(df).collect()}
    for k, record in enumerate(records):
        fields = strictly(record)
        if fields is None:
            assert why[k] == "quoting"
        elif len(fields) != 3:
            assert why[k] == "column_count"
        else:
            assert loaded[k] == fields and k not in why


def test_very_long_record(spark):
    long = 'A,"' + 'x""y,' * 40_000 + '",lineage'
    spaced = "A," + " " * 200_000 + ",lineage"
    assert reasons(spark, "panel", PANEL, [long, spaced, long + '"']) == {2: "quoting"}

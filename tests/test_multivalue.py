from slideloom.operators.multivalue import split_rule, split_values

CASES = {
    "A1;B2": ["A1", "B2"],
    " A1 ; ;B2;": ["A1", "B2"],
    '"A, total",B': ["A, total", "B"],
    '"say ""x""";B': ['say "x"', "B"],
    '["A","B, c"]': ["A", "B, c"],
    "['A', \"5'-B\"]": ["A", "5'-B"],
    '["A \\"q\\"", "B"]': ['A "q"', "B"],
    "“A;9”、B；C": ["A;9", "B", "C"],
    "'A, short' | 5'-B": ["A, short", "5'-B"],
    "A/B / C": ["A/B", "C"],
    "A\tB\nC long form|D": ["A", "B", "C long form", "D"],
    "A,A": ["A", "A"],
    '""': [],
    ";;": [],
    '"A;B': ['"A', "B"],
    "p1(a), b": ["p1(a)", "b"],
    'A "x" b;C': ['A "x" b', "C"],
}


def test_cases(spark):
    rows = [(k, text, "clash") for k, text in enumerate(CASES)] + [(100, None, ""), (101, "", ""), (102, "  ", "")]
    found = {}
    for r in split_values(spark.createDataFrame(rows, "id bigint, field string, skeleton string"), "id", "field", "value").orderBy("id", "position").collect():
        found.setdefault(r.id, []).append((r.position, r.value))
    for k, (text, values) in enumerate(CASES.items()):
        assert found.get(k, []) == list(enumerate(values, 1)), text
    assert not {100, 101, 102} & found.keys()


def test_repeats_long_and_empty(spark):
    long = ";".join(f"v{k}" for k in range(20_000))
    df = spark.createDataFrame([(1, long), (1, "a;b"), (1, "a;b")], "id bigint, field string")
    out = split_values(df, "id", "field", "value")
    assert out.count() == 20_004 and out.where("position = 20000 and value = 'v19999'").count() == 1
    assert split_values(df.limit(0), "id", "field", "value").count() == 0


def test_shuffled_rules_give_the_same(spark, monkeypatch):
    import slideloom.operators.multivalue as M

    df = spark.createDataFrame([(k, t) for k, t in enumerate(CASES)], "id bigint, field string")
    few = sorted(map(tuple, split_values(df, "id", "field", "value").collect()))
    monkeypatch.setattr(M, "BROADCAST_BYTES", 1)
    assert sorted(map(tuple, split_values(df, "id", "field", "value").collect())) == few


def test_rule_is_of_the_skeleton():
    assert split_rule('"a; a",a') == [(1, 4, ""), (7, 1, "")]

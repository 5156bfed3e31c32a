import pytest

pytest.importorskip("slideloom.llm")

from slideloom.llm import markers as M  # noqa: E402

ENTRIES = [("QX163", "QX163"), ("QX16", "QX16"), ("TK1", "TK-1"), ("TKL1", "TK-L1"), ("HMCI", "HMC I"), ("HMCIV", "HMC IV"), ("Corb", "Cor-β"), ("Zir6c", "Zir6c"), ("Zir6g", "Zir6g"), ("MibkavadrinIV", "Mibkavadrin IV"), ("Zimadrin", "Zimadrin"), ("ZimsolysinII", "Zimsolysin II"), ("PanGalfenasin", "Pan-Galfenasin"), ("Quatororing", "Quatororin γ"), ("Blank", None)]
MEANT = {
    " qx163 ": "QX163", "QX163 (clone 4A4)": "QX163", "anti-QX163": "QX163", "ｑｘ１６３": "QX163", "qх163": "QX163", "QX164": None, "QX 16": "QX16", "tk_1": "TK1", "TK 2": None, "TKL1": "TKL1",
    "HMC 4": "HMCIV", "hmc-i": "HMCI", "HMC II": None, "HMC": None, "Cor beta": "Corb", "COR-Β": "Corb", "Cor γ": None, "zir6C": "Zir6c", "Zir6d": None, "Mibkavvadirn IV": "MibkavadrinIV", "mibkavadrin4": "MibkavadrinIV",
    "Mibkavadrin III": None, "Mibkavadrin": None, "Zimadrin": "Zimadrin", "Zimadrin B": None, "Zimadrin-4": None, "Zmiadrinn": "Zimadrin", "Zimxxdxin": None, "Zimadr.": "Zimadrin", "Galfenasin (pan)": "PanGalfenasin",
    "zimsolysni ii": "ZimsolysinII", "Zimsolysin I": None, "quatororin gamma": "Quatororing", "QUATORORING": "Quatororing", "": None, "?": None, "blnk": None, "core R534": None, "x" * 30_000: None,
}


def tables(spark):
    rows = [(k, v, None, "clash") for k, v in enumerate(MEANT)] + [(900, None, "a;'tk 1';HMC I", ""), (901, "Lab-U1", 'q | "ZIR6G" | TK-1', ""), (902, "TK-1", "HMC IV", ""), (903, "Lab-U1", None, ""), (904, " qx163 ", "", "")]
    return spark.createDataFrame(rows, "id bigint, marker string, aliases string, entry string"), spark.createDataFrame(ENTRIES, "Marker string, Marker_orig string")


def test_meanings(spark):
    panels, names = tables(spark)
    found = {r[0]: r[1] for r in M.matched(panels, names, "id", "marker", "aliases", "Marker", "Marker_orig").collect()}
    assert {v: (found.get(k), m) for k, (v, m) in enumerate(MEANT.items()) if found.get(k) != m} == {}
    assert (found[900], found[901], found[902], found.get(903), found[904]) == ("TK1", "Zir6g", "TK1", None, "QX163")
    missed = {r[0] for r in M.misses(panels, M.matched(panels, names, "id", "marker", None, "Marker", "Marker_orig"), "id", "marker").collect()}
    assert {"QX164", "?", None, "Lab-U1"} <= missed


def test_join_gives_what_the_broadcast_gives(spark):
    panels, names = tables(spark)
    entries = M.dictionary(names, "Marker", "Marker_orig")
    values = panels.select(panels.marker.alias("value"))
    for loose in (True, False):
        small = {tuple(r) for r in M.meanings(values, entries, loose).collect()}
        assert small and {tuple(r) for r in M.meanings(values, entries, loose, most_entries=1).collect()} == small


def test_symmetric_deletes_miss_nothing():
    import random

    rnd = random.Random(2)
    rows = [(e, s, t) for e, p in ENTRIES for s, t in M.forms(e, p or e)]
    book = M.built(rows)
    for _ in range(300):
        entry, stem, tail = rnd.choice([r for r in rows if len(r[1]) >= 8])
        s = list(stem)
        for _ in range(2):
            k = rnd.randrange(1, len(s) - 1)
            act = rnd.randrange(4)
            if act == 0:
                del s[k]
            elif act == 1:
                s.insert(k, s[k])
            elif act == 2:
                s[k - 1], s[k] = s[k], s[k - 1]
            else:
                s[k] = rnd.choice("bdklmnprst")
        typed = "".join(s) + tail
        if M.distance("".join(s), stem, 2) < float("inf") and M.agrees(typed, typed, stem, tail):
            assert entry in {f[1] for f in book.lookup(typed, True)}, typed


def test_empty(spark):
    panels, names = tables(spark)
    assert M.matched(panels.limit(0), names, "id", "marker", "aliases", "Marker", "Marker_orig").count() == 0
    assert M.matched(panels, names.limit(0), "id", "marker", "aliases", "Marker", "Marker_orig").count() == 0

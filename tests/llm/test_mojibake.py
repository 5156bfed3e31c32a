import random

import pytest

pytest.importorskip("slideloom.llm")

from slideloom.llm import mojibake as M  # noqa: E402

PHRASES = {
    "fr": ["La fermeture est étanche, c’est parfait.", "Reçu en avance et bien emballé, bravo à l’équipe !", "Ma collègue l’a déjà commandé.", "Âge conseillé : dès huit ans.", "Après trois mois, aucun défaut."],
    "ru": ["Запах ужасный, пришлось вернуть.", "Доставили за три дня, упаковано аккуратно.", "Крышка закрывается плотно.", "Отличная вещь, пользуюсь каждый день."],
    "en": ["There’s a café round the corner.", "I can’t recommend it – sorry.", "It cost £99 and it still works.", "Great product, thank you.", "Kept at 26 °C all day."],
    "pt": ["A minha irmã já encomendou outro: MAÇÃ VERDE!", "Não serve para nada, a peça não encaixa.", "É mais leve do que parece.", "A tampa fecha bem e não há fugas."],
}


def sample():
    rnd = random.Random(0)
    return {lang: [" ".join(rnd.sample(p, 3)) for _ in range(120)] for lang, p in PHRASES.items()}


def wrongly(text, right, wrong, times=1):
    for _ in range(times):
        text = "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in text.encode(right))
    return text


@pytest.fixture(scope="module")
def measure():
    return M._Measure(M.fit(sample()))


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp437", "cp1251"])
def test_utf8_read_wrongly_comes_back(measure, wrong):
    for lang in ("fr", "ru", "pt", "en"):
        for text in sample()[lang][:6]:
            bad = wrongly(text, "utf-8", wrong)
            if bad != text:
                assert M.restored(bad, measure) == (text, True)


def test_twice_in_a_stretch_and_references(measure):
    text = sample()["fr"][0]
    assert M.restored(wrongly(text, "utf-8", "cp1252", 2), measure) == (text, True)
    mixed = text + " " + wrongly("Ma collègue l’a déjà commandé.", "utf-8", "cp1252")
    assert M.restored(mixed, measure) == (text + " Ma collègue l’a déjà commandé.", True)
    assert M.restored("There’s a caf&Atilde;&copy; round the corner.", measure) == ("There’s a café round the corner.", True)
    good = "There’s a caf&eacute; round the corner."
    assert M.restored(good, measure) == (good, False)


@pytest.mark.parametrize("right, wrong", [("cp1251", "cp1252"), ("koi8-r", "cp1251"), ("cp1252", "cp437")])
def test_single_byte_chains(measure, right, wrong):
    lang = "ru" if right != "cp1252" else "fr"
    for text in sample()[lang][:5]:
        new, found = M.restored(wrongly(text, right, wrong), measure)
        assert found and new == text


def test_good_text_stays(measure):
    for texts in sample().values():
        for text in texts[:20]:
            assert M.restored(text, measure) == (text, False)
    for text in ("", "plain", "👍 ❤️ ½ ŵ", "Ångström-sharp", "¯\\_(ツ)_/¯", "10 µm ±0"):
        assert M.restored(text, measure) == (text, False)
    assert M.restored("ungef�hr", measure)[1]


UNSEEN = {
    "fr": ["Le gérant était très désagréable, même après ma deuxième réclamation.", "Livré cassé : le côté gauche est fêlé."],
    "ru": ["Ручка отвалилась через неделю, магазин молчит.", "Сын доволен, просит второй такой же."],
    "pt": ["O botão avariou à primeira utilização, péssimo.", "Já está a enferrujar, não recomendo à ninguém."],
}


def test_words_outside_the_sample(measure):
    """Planted originals of words that the sample lacks: all found, UTF-8 ones restored exactly."""
    wrongs = [("utf-8", w) for w in ("cp1252", "mac_roman", "cp437", "cp850", "cp1251")]
    planted = [(t, wrongly(t, right, wrong)) for texts in UNSEEN.values() for t in texts for right, wrong in wrongs]
    planted += [(t, wrongly(t, "cp1251", "cp1252")) for t in UNSEEN["ru"]]
    for text, bad in planted:
        lossless = not any("\x80" <= c <= "\x9f" for c in bad)
        new, found = M.restored(bad, measure)
        assert found and (new == text or not lossless), (bad, new)
    for texts in UNSEEN.values():
        for text in texts:
            assert M.restored(text, measure) == (text, False)


def test_lost_bytes_are_marked(measure):
    bad = "".join(c for c in wrongly("Отличная вещь, пользуюсь каждый день. Крышка закрывается плотно.", "utf-8", "cp1252") if not "\x80" <= c <= "\x9f")
    new, found = M.restored(bad, measure)
    assert found and "\ufffd" in new and "вещ" in new and "Ð" not in new


def test_stretches_are_bounded_and_whole():
    for text in ("x y " * 1000, " " + "b" * 900 + " c", ("é" * 350 + "\t") * 9, " " * 1000, "Um. Dois! Três? " * 99, ""):
        assert "".join(M._stretches(text)) == text
    assert max(map(len, M._stretches("Ã© à " * 5000))) <= M.STRETCH_CHARS


def test_over_tables(spark):
    rows = [(k * 1000 + i, lang, t, "clash") for k, (lang, ts) in enumerate(sample().items()) for i, t in enumerate(ts)]
    bad = wrongly(rows[3][2], "utf-8", "cp1252")
    rows += [(90_000, None, bad, ""), (90_001, "fr", None, ""), (90_002, "fr", "", ""), (90_003, "fr", bad * 3000, ""), (90_000, None, bad, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string, garbled string")
    out = M.repair(df).collect()
    assert {r.doc_id for r in out if r.garbled} == {90_000, 90_003} and len(out) == len(rows)
    assert {r.restored for r in out if r.doc_id == 90_000} == {rows[3][2]}
    assert M.repair(df.limit(0)).count() == 0


def test_all_texts_are_learnt_from(spark, monkeypatch):
    """Words after the 600th text of a language and after its 2,000th sign count, as do the 25th language and on."""
    texts = sample()["fr"]
    rows = [(k, "fr", texts[k % len(texts)]) for k in range(700)]
    rows += [(1000 + k, "fr", "Très bien. " * 250 + "Un mot inouï.") for k in range(2)]
    rows += [(2000 + 100 * k + i, f"l{k:02}", f"Ĝis la ŝipo numero {i}, ĉiam.") for k in range(26) for i in range(8)]
    monkeypatch.setattr(M, "BUCKET_CHARS", 20_000)
    monkeypatch.setattr(M, "MERGED", 2)
    model = M.train(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"))
    assert model.words["inouï"] == 2 and len(model.dictionaries) == 27
    own = sum("étanche" in t and M._clean(t) for _, lang, t in rows if lang == "fr")
    assert own > 0 and model.words["étanche"] == own
    assert model.dictionaries["fr"] and all(len(d) <= M.DICTIONARY_BYTES for d in model.dictionaries.values())

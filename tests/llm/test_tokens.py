import base64
import os
import random

import pytest

pytest.importorskip("slideloom.llm")
if not os.path.exists("/opt/tokenizers/byte_bpe_50k.json"):
    pytest.skip("no tokenizer files here", allow_module_level=True)

from slideloom.llm import tokens as T  # noqa: E402

TEXTS = ["Hello  world\n", "", None, "   ", "née ½ 👍🏽 ￿ <|endoftext|> Привет 満足", "a" * 60_000, "é" * 5000, "\x00\x7f­", "x y\r\n"]


def documents(spark):
    return spark.createDataFrame([(k, t, "clash") for k, t in enumerate(TEXTS)], "doc_id bigint, text string, ids string")


def test_ids_and_round_trip(spark):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb"))}
    import public_tokenizers as P

    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {r.doc_id: r.ids for r in T.encode(documents(spark)).collect()}
    assert ids == {k: other.encode_ordinary(t or "") for k, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in T.decode(T.encode(documents(spark))).collect()} == {k: t or "" for k, t in enumerate(TEXTS)}


def test_offsets(spark):
    by = {}
    for r in T.encode_with_offsets(documents(spark)).orderBy("doc_id", "position").collect():
        by.setdefault(r.doc_id, []).append(r)
    for k, rows in by.items():
        text = TEXTS[k]
        assert rows[0].start == 0 and rows[-1].end == len(text)
        assert all(a.start <= b.start <= a.end for a, b in zip(rows, rows[1:]))
    assert 1 not in by and 2 not in by


def test_split_characters_and_unknown_ids():
    rnd = random.Random(1)
    for _ in range(50):
        text = "".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0xA0, 0x2FFF), rnd.randrange(0x1F300, 0x1F700)])) for _ in range(30))
        assert T.decoded(next(T.encoded([text])).ids) == text
    cut = next(T.encoded(["👍"])).ids[:1]
    assert "�" in T.decoded(cut) and T.decoded([10**9]) == "�" and T.decoded(None) == ""


def test_lengths_leave_out_null_and_empty(spark):
    sizes = {r.doc_id: r.size for r in T.lengths(documents(spark)).collect()}
    assert set(sizes) == {0, 3, 4, 5, 6, 7, 8} and sizes[0] == len(next(T.encoded([TEXTS[0]])).ids)
    assert T.encode(documents(spark).limit(0)).count() == 0

import random

import pyarrow as pa
import pytest

from faultline.llm import sentencepiece as S
from tests.llm.helpers import documents, empty

library = pytest.importorskip("sentencepiece")
HARD = [
    "Hello  world \n\t é ñ 你好 🙂", " a  b ", "", " ", "\n", "▁x▁▁y", "   lead", "trail   ", "\n\n  \n x", "<s> </s> <0x41>", "𝔘𝔫𝔦", "a" * 31,
    "1234567890" * 5, " " * 100, "x" + " " * 37 + "é", "   é   " + " " * 15 + "你" + " " * 16 + "\u0000​", "क्षि नमस्ते", "def f(x):\n    return x", "z" * 3000,
]


@pytest.fixture(scope="module")
def both():
    return S.Transducer(S.Model(S.load())), library.SentencePieceProcessor(model_file=S.MODEL)


def test_encodes_as_the_library(both):
    own, lib = both
    rng = random.Random(1)
    texts = HARD + ["".join(rng.choice("abcdeéñ ▁ \n  1你🙂the") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += [" " * k + "w" for k in range(70)] + [" " * k for k in range(70)]
    for text in texts:
        assert own.encode(text) == lib.encode(text), text


def test_path_is_what_merging_gives(both):
    own, _ = both
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice("thearnosi.,") for _ in range(rng.randint(1, 24)))
        assert own.shortest(text) == own.merged(text)


def test_decodes_as_the_library(both):
    own, lib = both
    rng = random.Random(3)
    for _ in range(800):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(259)]) for _ in range(rng.randint(1, 20))]
        assert own.decode(ids) == lib.decode(ids)
        assert own.decode_all(pa.array([[], ids, None], pa.list_(pa.int32()))) == ["", own.decode(ids), ""]


def test_caches_are_bounded(both, monkeypatch):
    own, lib = both
    monkeypatch.setattr(S, "WORDS_KEPT", 3)
    monkeypatch.setattr(S, "PAIRS_KEPT", 3)
    own.words.clear()
    text = "one two three four five six seven"
    assert own.encode(text) == lib.encode(text) and len(own.words) <= 3


def test_columns_come_back(spark):
    model = S.load()
    docs = documents(spark, [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "é 你"), (4, "x▁y")])
    back = S.decode(S.encode(docs, model), model, to="decoded")
    rows = back.select("doc_id", "ids", "decoded", "Kept").collect()
    assert [r["decoded"] for r in rows] == ["", "", "a b", "a b", "é 你", "x y"]
    assert rows[0]["ids"] == [] and all(r["Kept"] == 1 for r in rows)
    assert S.encode(empty(spark), model).count() == 0


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        S.Model(b"\x12\x02\x18\x01")

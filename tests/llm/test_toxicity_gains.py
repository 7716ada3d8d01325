"""Gains of whole blocks of texts against one window at a time, and which windows are compressed at all."""

import random

import numpy as np
import pyarrow as pa
import zstandard

from tidemark.llm import toxicity

TEXTS = [None, b"", b" \n", b"...", b"A", b"(a) !! b", b"You poor SCUM; you, poor scum", b"x" * 300_000 + b" moron " + b"z" * 5000, b"scum moron " * 400]


def a_model():
    plain = b" the weather is fine today and we walk along the river to the old mill" * 4
    said = b" moron scum worthless bad trash ", b" weather river walk old mill tod "
    return toxicity.ToxicityModel(plain, *(words.rjust(64, b"\0") for words in said))


def one_by_one(model, text):
    """The definition: for each window the difference of two compressed lengths, none where no five bytes are shared."""

    def size(content, window):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            3, source_size=128, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, min_match=5, strategy=zstandard.STRATEGY_DFAST,
        )
        known.precompute_compress(compression_params=settings)
        return len(zstandard.ZstdCompressor(dict_data=known, compression_params=settings).compress(model.base[-64:] + window))

    out = []
    for window in toxicity.windows_of(toxicity.words_of(text)):
        shared = any(window[k : k + 5] in model.toxic or window[k : k + 5] in model.ordinary for k in range(len(window) - 4))
        out.append(size(model.base + model.ordinary, window) - size(model.base + model.toxic, window) if shared else 0)
    return out


def test_blocks_give_what_single_windows_give(monkeypatch):
    draw = random.Random(9)
    model, pool = a_model(), [b"scum", b"bad,", b"(Moron)", b"river", b"walk", b"\xff\x00", b"...", "né".encode(), b"qqqq", b"today"]
    texts = TEXTS[:8] + [draw.choice([b" ", b"\t"]).join(draw.choices(pool, k=draw.randint(0, 30))) for _ in range(60)]
    expected = [one_by_one(model, text or b"") for text in texts]
    assert any(gain > 0 for gains in expected for gain in gains) and any(gain < 0 for gains in expected for gain in gains)
    assert [model.gains(text or b"").tolist() for text in texts] == expected
    whole = model.features(pa.array([b"left out", *texts], pa.binary()).slice(1))
    assert np.array_equal(whole, [model._summary(np.array(gains, float)) for gains in expected])
    monkeypatch.setattr(toxicity, "_BLOCK_BYTES", 50)
    monkeypatch.setattr(toxicity, "_CALL_BYTES", 100)
    assert np.array_equal(a_model().features(pa.array(texts, pa.binary())), whole)


def test_windows_are_compressed_once_and_only_where_they_can_match(monkeypatch):
    model, sent = a_model(), []
    inner = model._gains_of
    monkeypatch.setattr(model, "_gains_of", lambda windows: sent.extend(windows) or inner(windows))
    gains = model.gains(TEXTS[-1])
    assert len(gains) == 799 and (gains > 0).any() and len(sent) == 3  # two windows of three words, the last of two
    sent.clear()
    assert not model.gains(b"nothing here could ever come near " * 30).any() and not sent

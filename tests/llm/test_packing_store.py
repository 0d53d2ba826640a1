"""The tokenizer is asked once for what comes again and again, however much comes between."""

import public_tokenizers
import pytest

from fieldlake.llm import packing


@pytest.fixture
def encoder():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return packing.Encoder(file.read())


def test_words_in_use_outlive_a_full_store(encoder, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_BYTES", 400)
    plain, asked = encoder.tokenizer, []

    class Told:
        def encode_batch_fast(self, some, **options):
            asked.extend(some)
            return plain.encode_batch_fast(some, **options)

    encoder.tokenizer = Told()
    some = [f"The same wörds, again... x{i}y{i}z <a> 'tis {i}" for i in range(60)]
    got = encoder.encode(some)
    want = [plain.encode(x, add_special_tokens=False).ids for x in some]
    assert [x.tolist() for x in got] == want
    assert [asked.count(x) for x in ("the", "same", "wörds", "again", "'tis")] == [1] * 5
    assert len(encoder.known) + len(encoder.before) < 120

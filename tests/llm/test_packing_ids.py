"""Token ids of odd texts, whole and by the words the encoder looks up."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandpanel.llm import packing

ODD = ["İ", "Σ", "ς", "café", "Å", "क़", "ẞ", "ﬁ", "'s", "1", "x", "Ab", "ǅ", "\U0001f600", "ͅ", "​", " ", "\t", "\x1c", " ", ".", ")", "!?", "ᾳ", "가", "ำ", "\U00010400"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_odd_texts(name):
    path = public_tokenizers.path(name)
    encoder, plain, draw = packing.Encoder(path), Tokenizer.from_file(path), random.Random(4)
    texts = ["café İ.", "İ.", "Σİ) İ!"]
    for _ in range(3000):
        texts.append("".join(draw.choice([*ODD, " ", " ", "\n"]) if draw.random() < 0.8 else chr(draw.choice([draw.randrange(0xD800), draw.randrange(0xE000, 0x110000)])) for _ in range(draw.randint(1, 25))))
    wrong = [t for t in texts if encoder(t) != np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()]
    assert not wrong, wrong[:3]

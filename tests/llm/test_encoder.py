"""Ids of words against the library."""

import pyarrow as pa
import pytest
from helpers import random_texts
from test_tokens import TEXTS, random_unicode
from tokenizers import Tokenizer

from genoframe.llm import packing, tokens


@pytest.mark.parametrize("memory", [3, 250_000])
def test_ids_equal_the_library(monkeypatch, memory):
    monkeypatch.setattr(packing, "MEMO_WORDS", memory)
    library = Tokenizer.from_file(tokens.vocabulary())
    encoder = packing.WordEncoder(tokens.vocabulary())
    texts = TEXTS + random_unicode(600, 4) + random_texts(50, 2) + ["a., B, c.. .d ªº, ⅷ. ΑΣ, ΣΣ."]
    for group in (texts, texts[::-1], [None], ["a, " * 700_000 + "Béta."], texts):
        for text, ids in zip(group, encoder.encode(pa.array(group, pa.string())), strict=True):
            expected = library.encode(text or "", add_special_tokens=False).ids
            assert ids.tolist() == expected, repr(text)

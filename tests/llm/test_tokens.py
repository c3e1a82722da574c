"""The two tokenising operators against the tokenizers library, string by string."""

import os
import random

import numpy as np
import pytest
from voxelloom.llm import bpe, packing, queries

POOLS = ["abcdefghijklmnopqrstuvwxyz", "ABCxyz'stremdvl", "0123456789", "!?.,;:-_()[]{}<|>@#$%^&*~`'\"\\/", "éèàüöñçÉÀßØÿµªº×÷ÿ", "क़य़ड़़्ािיִשׁשּׁ﬩̧̀́̈ﬁİıŉſΣςσ", "日本語ひらがな한국어각", "😀🎉👍🏽‍\u0000\x01\x1c\x1f\x85\xa0 　﻿"]
FIXED = ["<|endoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>b", "x" * 500, "it's We'LL 'S ''s '''t", "क़!", "שׁ?", "", " ", "é́", "́a"]


def strings(vocab: list[str], n: int) -> list[str]:
    random.seed(3)

    def word() -> str:
        if random.random() < 0.3:
            return random.choice(vocab) + random.choice(["", random.choice(vocab), random.choice("!'.,9")])
        return "".join(random.choice(random.choice(POOLS) if random.random() < 0.4 else POOLS[random.choice((0, 3, 4, 5))]) for _ in range(random.randrange(1, 7)))

    return FIXED + ["".join(word() + random.choice(["", " ", "\n", " \t "]) for _ in range(random.randrange(1, 5))) for _ in range(n)]


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_library_s(file):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = queries.tokenizer(file)
    library = Tokenizer.from_file(path)
    some = [t.replace("</w>", "") for t in library.get_vocab() if t.replace("</w>", "").isascii()]
    texts = strings(some, 100_000)
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    if file.startswith("word"):
        words = packing.Words(path)
        got = [np.frombuffer(x, words.kind).tolist() for x in words.encode([t.encode() for t in texts])]
    else:
        own = bpe.Bpe(path)
        got = [x.tolist() for x in own.encode(texts)]
        assert [own.decode(np.array(w)) for w in want[:20_000]] == [library.decode(w, skip_special_tokens=False) for w in want[:20_000]]
    assert [t for t, a, b in zip(texts, want, got, strict=True) if a != b] == []


def test_a_store_that_starts_anew_changes_no_id(monkeypatch):
    words = packing.Words(queries.tokenizer("word_bpe_49k.json"))
    texts = [t.encode() for t in strings(["tele", "graph", "ic"], 2000)]
    want = words.encode(texts)
    monkeypatch.setattr(packing, "KEPT", 5)
    assert packing.Words(queries.tokenizer("word_bpe_49k.json")).encode(texts) == want

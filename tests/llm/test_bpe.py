import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridmill.llm.automaton import Lexicon, build
from gridmill.llm.bpe import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(PATH)


def library():
    return Tokenizer.from_file(PATH)


TEXTS = [
    "", " ", "Hello, World's best — naïve café 123 ½ ² x\x1cy\x85z", "a<|endoftext|>B <|startoftext|>", "ΣΟΦΌΣ ὈΔΥΣΣΕΎΣ İstanbul", "éá ́x",
    "日本語テキスト 😀😀 ​zero", "x" * 500, "!?" * 300, "don't they'll I'm we've 'sup", "tab\tnew\nline\r\n  end  ", "null\x00byte �",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_text_equal_the_library(bpe, text):
    enc = library().encode(text, add_special_tokens=False)
    lexicon = Lexicon(build({w: bpe.encode_words([w])[0] for w in ("hello", "hell", "world", "123", "café")}))
    for lex in (None, lexicon):
        ids = bpe.encode(text, lex)
        assert ids == enc.ids
        assert bpe.decode(ids) == library().decode(ids, skip_special_tokens=False)


def test_random_words(bpe):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgthéßöñ'!0") for _ in range(rng.randint(1, 40))) for _ in range(400)]
    lib = library()
    for w in words:
        assert bpe.encode(w) == lib.encode(w, add_special_tokens=False).ids


def test_automaton_is_minimal_and_exact():
    words = {w: [i, i * 7] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "é", "éa", "a"])}
    lex = Lexicon(build(words))
    asked = [*words, "to", "tapsx", "", "zz"]
    got = lex.numbers([w.encode() for w in asked])
    for w, k in zip(asked, got, strict=True):
        assert (lex.ids(k).tolist() if k >= 0 else None) == words.get(w)
    # t -> {a, o} -> p -> s is shared by tap(s) and top(s); stop and the two others stay apart.
    assert len(lex.keys) == 13
    assert Lexicon(build({})).numbers([b"a"]).tolist() == [-1]

import random

from public_tokenizers import path
from tokenizers import Tokenizer

from cinelake.llm import packing


def test_literal_special_tokens_are_the_fresh_tokenizers():
    fresh = Tokenizer.from_file(path("word_bpe_49k.json"))
    rng = random.Random(4)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", " ", "\n", "word", "it's", "12,5", "É日", "..", "<", ">"]
    texts = ["end <|endoftext|> next", "", "<|endoftext|>", "plain words", "a<|startoftext|><|endoftext|>'s"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["x <|endoftext|> y " * 3000]
    ids = packing.TextIds(path("word_bpe_49k.json"))
    assert ids.of([b"end <|endoftext|> next"])[0].tolist() == [806, 49407, 1131]
    for text, got in zip(texts, ids.of([t.encode() for t in texts])):
        assert got.tolist() == fresh.encode(text, add_special_tokens=False).ids

"""What a worker process keeps between tasks."""

import public_tokenizers
import pytest


def test_an_encoder_serves_the_tasks_that_follow():
    from gablestone.llm import token_frames

    file = public_tokenizers.path("byte_bpe_50k.json")
    text = "some words, and Some more words."
    own = token_frames.encoder(file, "a")
    first = [x.tolist() for x in own.batch([text])]
    n = own.n
    assert token_frames.encoder(file, "a") is own and [x.tolist() for x in own.batch([text])] == first and own.n == n
    # What it had not learned when a task failed is learned anew.
    learn, own._ids = own._ids, lambda texts: 1 / 0
    with pytest.raises(ZeroDivisionError):
        list(own.batch(["quite another one"]))
    own._ids = learn
    assert [x.tolist() for x in own.batch(["quite another one", text])] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in ("quite another one", text)]
    assert token_frames.encoder(file, "b") is not own


def test_encoder_keeps_the_pieces_of_a_large_share():
    from gablestone.llm import token_frames

    own = token_frames.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    learned = []

    def learn(keys):
        learned.append(len(keys))
        own.n += len(keys)

    own._learn = learn
    texts = ["".join(f" w{i}" for i in range(k, k + 50_000)) for k in range(0, 900_000, 50_000)]
    for _ in range(2):
        for _ in own._numbered(texts):
            pass
    assert sum(learned) == 900_000

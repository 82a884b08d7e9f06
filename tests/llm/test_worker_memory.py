"""What a worker keeps between tasks."""

import pandas as pd

from outcomelab.llm import common, substring


def test_settings_of_memory_wait_for_a_second_operator(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "_ACTIVE", [None])
    monkeypatch.setattr(common, "_steady", lambda: calls.append(1))
    monkeypatch.setattr(common, "release", lambda: None)
    common.use_memos("encoders")
    common.use_memos("encoders")
    assert not calls
    common.use_memos()
    assert calls == [1]


def test_locating_drops_the_word_memo(monkeypatch):
    monkeypatch.setattr(common, "_ACTIVE", ["words"])
    monkeypatch.setattr(common, "_steady", lambda: None)
    common.word_hashes([b"left", b"by", b"stage"])
    rows = pd.DataFrame([(0, 7, 0, 4, b"a b c d"), (0, 8, 5, 5, b"x a b c d"), (0, 9, 2, 3, b"p q r"), (0, 7, 9, 4, None)],
                        columns=["shard", "k", "a", "words", "text"])
    got = substring._locate(3)(rows)
    assert not common._MEMO
    assert sorted(map(tuple, got.to_numpy().tolist())) == [(7, 0, 4), (7, 9, 13), (8, 6, 10)]

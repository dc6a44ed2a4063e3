import tracemalloc

from sparkprep.llm.cache import LONGEST, Memo


def test_results_are_kept_within_limits():
    asked = []
    memo = Memo(lambda word: asked.append(word) or word.upper(), 3)
    assert [memo[w] for w in "abcabcd"] == list("ABCABCD") and asked == list("abcd")
    assert len(memo) + len(memo.older) <= 6
    assert memo["x" * (LONGEST + 1)] == "X" * (LONGEST + 1) and memo["x" * (LONGEST + 1)] and len(asked) == 6
    assert max(map(len, [*memo, *memo.older])) <= LONGEST


def test_long_paragraphs_take_no_room():
    memo = Memo(lambda text: text.encode("utf-32"), 200_000)
    tracemalloc.start()
    for i in range(20_000):
        memo["日" * 1500 + str(i)]
    assert tracemalloc.get_traced_memory()[1] < 10_000_000
    tracemalloc.stop()

import random

import numpy as np
import pyarrow as pa

from sparkprep.llm.batches import PRIME, Spans, mix, powers, times, utf8, word_hashes, word_ids, words


def thue_morse(swap=False):
    """A word of 1,024 letters whose polynomial modulo 2^64 equals that of the word with its two letters swapped."""
    return "".join("ab"[bin(i).count("1") % 2 ^ swap] for i in range(1024))


def test_words_get_hashes_of_their_own():
    texts = pa.array([f"{thue_morse()} {thue_morse(True)} x", None, " x\ty  x\n", "日本 x"])
    raw, offsets = utf8(texts)
    starts, ends, doc = words(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    numbers, different = word_ids(raw, starts, ends)
    assert [different[i].as_py() for i in numbers.tolist()] == [raw[a:b].tobytes() for a, b in zip(starts, ends)]
    assert len(set(hashes.tolist())) == len(different) == 5
    many = " ".join(dict.fromkeys(f"{'é' * (i % 9)}{i}" for i in range(20_000))) + " " + "z" * 9_000 + " " + "z" * 9_001 + " 00000000 0000000 000000000 00000000\x00"
    raw, offsets = utf8(pa.array([many]))
    starts, ends, _ = words(raw, offsets)
    assert len(set(word_hashes(raw, starts, ends).tolist())) == len(many.encode().split()) == len(set(many.split(" ")))
    again = word_hashes(*(lambda r, o: (r, *words(r, o)[:2]))(*utf8(pa.array(["x"]))))
    assert again[0] == hashes[2] and (hashes[numbers == numbers[2]] == again[0]).all()


def test_products_and_powers_modulo_the_prime():
    draw, prime = random.Random(4), int(PRIME)
    a = [0, 1, prime - 1, prime - 1, *[draw.randrange(prime) for _ in range(500)]]
    b = [5, prime - 1, prime - 1, 2, *[draw.randrange(prime) for _ in range(500)]]
    assert times(np.array(a, np.uint64), np.array(b, np.uint64)).tolist() == [x * y % prime for x, y in zip(a, b)]
    assert powers(12345, 300).tolist() == [pow(12345, i, prime) for i in range(300)]


def test_spans_with_equal_values_and_no_others_have_equal_hashes():
    letters = [int(c == "b") for c in thue_morse() + thue_morse(True)]
    values = mix(np.array(letters * 2, np.uint64) + np.uint64(9))
    for which in (0, 1):
        spans = Spans(values, which)
        one, other, same = spans(np.array([0, 1024, 2048]), np.array([1024, 2048, 3072])).tolist()
        assert one != other and one == same
        draw = np.random.default_rng(2)
        begin = draw.integers(0, 4000, 3000)
        end = begin + draw.integers(1, 9, 3000)
        seen = {}
        for a, b, h in zip(begin, end, spans(begin, end).tolist()):
            assert seen.setdefault(h, tuple(values[a:b])) == tuple(values[a:b])
        assert len(seen) == len(set(seen.values()))

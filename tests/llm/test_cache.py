from assaysift.llm import tokens
from assaysift.llm.common import BoundedCache, _live, packed


def test_frequent_keys_stay_however_many_rare_ones_pass():
    made = []
    cache = BoundedCache(lambda key: made.append(key) or key * 2, limit=100)
    for rare in range(1_000, 3_000):
        assert cache["often"] == "oftenoften" and cache[rare] == rare * 2
        assert len(cache) + len(cache.old) <= 100
    assert made.count("often") == 1


def test_byte_values_are_bounded_by_their_size():
    cache = BoundedCache(lambda n: bytes(n), limit=10**6, size=100_000)
    for n in range(2_000):
        assert len(cache[n]) == n  # the longest are not kept
    assert sum(len(v) + 150 for v in [*cache.values(), *cache.old.values()]) <= 100_000


def test_packed_ids_are_little_endian():
    assert packed([1, 0x01020304]) == b"\x01\0\0\0\x04\x03\x02\x01" and packed([]) == b""


def test_rare_words_of_a_worker_are_encoded_once():
    _live.clear()
    cache, made = tokens._worker(tokens._path(tokens.TOKENIZER))[2], []
    cache.make = lambda chunk: made.append(chunk) or b"\0\0\0\0"
    text = b" ".join(b"w%d" % i for i in range(350_000))
    assert len(tokens.encode(text)) == len(tokens.encode(text)) == 4 * 350_000
    assert len(made) == 350_000
    _live.clear()

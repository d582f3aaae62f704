import random

from tableflow.llm.losertree import common_prefix, decode, front_code, merge


def test_front_coding_round_trip():
    strings = sorted([b"", b"a", b"a", b"ab", b"abc\x00", b"b\xff", b"b\xff\x00"])
    shared, lengths, rests = front_code(strings)
    assert [s for _, s in decode(shared, lengths, rests)] == strings
    assert sum(lengths) < sum(map(len, strings))


def test_common_prefix_begins_after_what_is_known():
    assert common_prefix(b"xxab", b"yyac", 2) == 3  # the first two bytes aren't looked at
    assert common_prefix(b"ab", b"abc", 0) == 2
    assert common_prefix(b"a\x00b", b"a\x00c", 0) == 2


def test_merge_equals_sorting_and_gives_the_shared_prefixes():
    generator = random.Random(5)
    for runs in (1, 2, 3, 7, 16):
        parts = [
            sorted(bytes(generator.choices(b"ab", k=generator.randrange(12))) for _ in range(generator.randrange(40)))
            for _ in range(runs)
        ]
        found = list(merge([decode(*front_code(p)) for p in parts]))
        assert [s for _, s, _ in found] == sorted(s for p in parts for s in p)
        before = b""
        for shared, s, _ in found:
            assert shared == common_prefix(before, s, 0)
            before = s
        for k, p in enumerate(parts):
            assert [s for _, s, run in found if run == k] == p


def test_merge_without_strings():
    assert list(merge([])) == [] and list(merge([iter(()), iter(())])) == []

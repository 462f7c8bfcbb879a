"""Literals of scripts: the forward scan against the patterns that say what a literal is, and its time."""

import random
import re
import time

import pytest

from vitrine.sources import mapscript as M

# what counts as a literal, as patterns whose time can grow with the square of the script and more
PATTERNS = [
    (M.json_calls, re.compile(r"""JSON\.parse\(\s*("(?:\\.|[^"])*"|'(?:\\.|[^'])*')\s*\)""")),
    (lambda s: M.enclosed(s, M.OPEN_LIST, M.CLOSE_LIST), re.compile(r"(?:shops|stores|points|markers|features)\s*[:=]\s*(\[[\s\S]*?\])\s*[;,}]", re.IGNORECASE)),
    (M.telling_lists, re.compile(r'(\[[\s\S]*?"(?:address|lat|lng|coords|balloonContent)"[\s\S]*?\])', re.IGNORECASE)),
    (lambda s: M.enclosed(s, M.OPEN_OBJECT, M.CLOSE_OBJECT), re.compile(r"(?:objects|shopsData|storesData|mapData)\s*[:=]\s*(\{[\s\S]*?\})\s*[;,]", re.IGNORECASE)),
    (M.collections, re.compile(r'(\{[\s\S]*?"features"\s*:\s*\[[\s\S]*?\][\s\S]*?\})')),
]
PIECES = ["[", "]", "{", "}", ";", ",", " ", "\n", "x", "shops", "Stores =", "features: ", '"features" :', '"address"', '"LAT"', "mapData=", "objects:", "JSON.parse(", ")", '"', "'", "\\", '\\"', "\\'", "\\\\"]


@pytest.mark.parametrize("which", range(len(PATTERNS)))
def test_same_literals_as_the_patterns(which):
    scan, pattern = PATTERNS[which]
    rng, found = random.Random(which), 0
    own = [["JSON.parse(", "JSON.parse('", '")', "')"], ["shops=[", "];", "]}"], ['["lat"', '"coords"'], ["mapData={", "};"], ['{"features":[', "]}"]][which]
    for _ in range(6000):
        script = "".join(rng.choice(PIECES + own * 6) for _ in range(rng.randrange(1, 22)))
        want = [m[1] for m in pattern.finditer(script)]
        found += bool(want)
        assert list(scan(script)) == want, script
    assert found > 300


@pytest.mark.parametrize("script", ["[" * 2_500_000, "{" * 2_500_000, "shops=[" * 400_000, 'JSON.parse("' * 300_000, 'JSON.parse("' + '\\"' * 1_500_000, '["lat"' * 500_000, '{"features":[' * 300_000, "mapData={" * 400_000])
def test_long_scripts_that_close_nothing(script):
    began = time.time()
    assert M.script_candidates(script) == []
    assert time.time() - began < 10


def test_a_long_script_with_a_list_at_its_end():
    filler = "function f(a){return [a, {b: [1, 2]}];}\n" * 125_000  # 5 MB
    began = time.time()
    got = M.script_candidates(filler + 'var shops = [{"address": "ул. Новая, 3"}];')
    assert [c["address"] for c in got] == ["ул. Новая, 3"] and time.time() - began < 10

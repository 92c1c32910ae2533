"""What has to occur for a kind's patterns to be tried is no narrower than the patterns."""

from __future__ import annotations

import random
import re
from re import _constants as of
from re import _parser

import pytest

from rivulet.llm import pii

CHARS = [chr(c) for c in range(0x20, 0x7F)] + ["é"]


def written(tree, r):
    """A random string of a parsed pattern; assertions aren't looked at."""
    out = ""
    for kind, x in tree:
        if kind is of.LITERAL:
            out += chr(x)
        elif kind is of.IN:
            no = x[0][0] is of.NEGATE
            held = {c for k, v in x[no:] for c in ([chr(v)] if k is of.LITERAL else map(chr, range(v[0], v[1] + 1)))}
            out += r.choice([c for c in CHARS if c not in held] if no else sorted(held))
        elif kind in (of.MAX_REPEAT, of.POSSESSIVE_REPEAT):
            low, high, inner = x
            out += "".join(written(inner, r) for _ in range(r.randint(low, min(high, low + 18))))
        elif kind is of.SUBPATTERN:
            out += written(x[3], r)
        elif kind is of.BRANCH:
            out += written(r.choice(x[1]), r)
        else:
            assert kind in (of.ASSERT, of.ASSERT_NOT), kind
    return out


@pytest.mark.parametrize("kind", pii.KINDS)
def test_needed_is_necessary(kind):
    r = random.Random(5)
    for pattern in [pii.BASE[kind].replace(r"\G|", ""), *pii.LOOSE[kind]]:
        tree, tried = _parser.parse(pattern), 0
        for _ in range(3000):
            text = written(tree, r)
            if not re.search(pattern, text) or kind == "card" and len(re.sub("[^0-9]", "", text)) < 13:
                continue
            tried += 1
            assert re.search(pii.NEEDED[kind], text), (pattern, text)
        assert tried > 100, pattern


ALONE = ["call 0033 12 34 56 78", "mail john.doe (AT) mail (DOT) com", "write to jane [AT] mail.org", "host 2001:db8::1", "from fe80::1", "ip ::1f", "host 2001:db8:0:1::"]


def test_found_without_help(spark):
    other = "; order 123 456, @ 9.9 a:b +1"
    rows = [(2 * i + k, t + other * k) for i, t in enumerate(ALONE) for k in (0, 1)]
    out = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in enumerate(ALONE):
        assert out[2 * i] == out[2 * i + 1], t
    assert [out[2 * i] for i in (0, 1, 2, 3, 4)] == ["phone:5:21", "email:5:33", "email:9:27", "ip:5:16", "ip:5:12"], out


def test_short_ipv6_forms():
    pattern = re.compile(pii.LOOSE["ip"][1])
    for t in ("2001:db8::1", "fe80::", "::1", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3::4:5:6:7", "fe80::1."):
        assert pattern.search(t) and pattern.search(t)[0] == t.rstrip("."), t
    for t in ("::", "std::find", "12345::1", "1:2:3:4::5:6:7:8", "1::2::3", "a:::b", "10:20:30", "::ffff:1.2.3.4"):
        assert not pattern.search(t), t

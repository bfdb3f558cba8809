import random
import re
from re import _constants as C
from re import _parser as parser

from tidemark.llm import license_rules as R
from tidemark.llm import license_scan as S

NAMED = tuple(S.PHRASES.items())


def example(pattern, rng):
    """A text that the pattern matches."""

    def walk(tree):
        out = ""
        for op, arg in tree:
            if op is C.LITERAL:
                out += chr(arg)
            elif op is C.IN:
                kind, value = arg[0]
                out += chr(rng.randint(*value)) if kind is C.RANGE else chr(value) if kind is C.LITERAL else "q"
            elif op is C.BRANCH:
                out += walk(rng.choice(arg[1]))
            elif op is C.MAX_REPEAT:
                low, high, inner = arg
                out += "".join(walk(inner) for _ in range(rng.randint(low, min(high, low + 2))))
            elif op is C.SUBPATTERN:
                out += walk(arg[3])
            elif op is C.NOT_LITERAL:
                out += "q"
            else:
                raise AssertionError(op)
        return out

    return walk(parser.parse(pattern))


def test_rules_match_their_examples_and_open_by_their_keywords():
    rng, (rules, patterns, _, needed) = random.Random(5), R.compiled(NAMED)
    assert len(rules) > 400
    for rule, compiled, words in zip(rules, patterns, needed):
        assert rule.keywords, rule
        for _ in range(20):
            line = example(rule.pattern, rng)
            assert re.fullmatch(rule.pattern, line) and compiled.search(line.encode()), (rule, line)
            assert words <= set(line.encode().split()), (rule, line)


def brute(found):
    """Each detection against each other one."""
    rules, out = R.compiled(NAMED)[0], []
    for d in found:
        inside = any(
            e != d and e[0] <= d[0] and e[1] >= d[1] and rules[e[2]].level <= rules[d[2]].level
            and (e[:2] != d[:2] or (rules[e[2]].level, e[2]) < (rules[d[2]].level, d[2])) for e in found
        )
        if rules[d[2]].pinned or not inside:
            out.append(d)
    return sorted(out)


def test_suppression_is_that_of_all_pairs():
    rng, rules = random.Random(6), R.compiled(NAMED)[0]
    for _ in range(200):
        found = {(a := rng.randint(0, 12), a + rng.randint(1, 6), rng.randrange(len(rules))) for _ in range(rng.randint(0, 25))}
        assert sorted(S.resolved(list(found), NAMED)) == brute(list(found))


def kept(text):
    words = text.encode().translate(S.AS_WORDS).split()
    line, rules = b" ".join(words), R.compiled(NAMED)[0]
    return [(rules[i].label, R.LEVELS[rules[i].level]) for _, _, i in S.resolved(S.detections(line, set(words), NAMED), NAMED)]


def test_overlaps_are_resolved():
    assert kept("GNU Lesser General Public License version 2.1 or any later version") == [("lgpl-2.1-or-later", "mention")]
    assert kept("SPDX-License-Identifier: GPL-2.0-or-later") == [("gpl-2-or-later", "tag")]
    assert kept("Licensed under CC BY-NC 4.0.") == [("cc-by-nc-4", "notice"), ("cc-by-nc", "notice")]
    assert kept("see https://www.gnu.org/licenses/gpl-3.0.html") == [("gpl-3", "page")]
    assert kept("the limit license plate, apache tribe, by nc") == []


def places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    found = []
    for phrase, label in S.PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(found)


def test_every_place_of_the_phrases_on_odd_rows(spark):
    pad = "wört x-1 " * 60_000
    texts = [None, "", " \n", "under THE mit License", "xunder the mit license", "under the mit licenses", "cc by nc cc by nc", "cc by\x00nc",
             "Apache-License (version 2)", "ÀPACHE license version 2", pad + "cc by nc " + pad + "cc-by-nc", "cc by nc " * 3000, "ccby nc"]
    rows = [(i, t, 7, "k") for i, t in enumerate([*texts, *texts[3:7]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, label string")
    out = S.scan(docs)
    assert out.columns == ["doc_id", "text", "label", "n_words", "detections"]
    for r in out.collect():
        pinned = sorted((d.first, d.label) for d in r.detections if d.pinned)
        assert (r.n_words, pinned) == places(r.text), r.text and r.text[:40]
        assert all(0 <= d.first <= d.last < r.n_words and 0 < d.weight <= 1 for d in r.detections)
    assert S.scan(docs.limit(0)).count() == 0


def test_query_counts_the_phrases(spark, sf):
    from tidemark.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_license_signatures"](spark, sf).collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for r in rows:
        n, found = places(texts[r.doc_id])
        starts = [i for i, _ in found]
        base = {x for _, x in found}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(found), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(base)) and base <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert any(set(r.labels.split(",")) - set(r.base_labels.split(",")) for r in rows)

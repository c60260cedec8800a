"""The pipeline's decisions, stage by stage, against brute force on a small planted corpus."""

import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline as P
import public_tokenizers
from test_free_operators import reachable, simhash
from test_native_operators import base, brute_line_dedup, brute_targets, WORD
from tokenizers import Tokenizer


def corpus():
    rnd = random.Random(11)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))

    rows = [(i, "\n".join(prose(30) for _ in range(rnd.randint(1, 5))), "en", f"s{i % 4}") for i in range(80)]
    passage = prose(60)
    rows += [(100 + i, prose(25) + "\n" + passage + "\n" + prose(25), "en", "s1") for i in range(6)]
    long = next(r[1] for r in rows if r[1].count("\n") > 1)
    rows += [(200 + i, long, "en", "s0") for i in range(9)]                             # exact copies
    rows += [(300 + i, prose(5), "en", "s2") for i in range(4)]                         # too short
    rows += [(400 + i, (prose(8) + " ") * 9, "en", "s3") for i in range(4)]             # repetitive
    short = prose(25)
    rows += [(500 + i, short + "  " * i, "en", "s2") for i in range(5)]                 # copies too short for runs
    return [(*r, len(r[1])) for r in rows]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long"), []
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, "/nowhere"), name)
        out.append(docs.collect())
    return out


def test_quality(stages):
    want = [r[0] for r in corpus() if not base(r[1])[-1]]
    assert sorted(r.doc_id for r in stages[0]) == sorted(want) and 80 + 6 + 9 + 5 == len(want)


def test_line_dedup(stages):
    cut = brute_line_dedup([(r.doc_id, r.text) for r in stages[0]])
    want = {d: t for d, t in cut.items() if WORD.search(t)}
    assert {r.doc_id: r.text for r in stages[1]} == want
    assert all(r.n_chars == len(r.text) for r in stages[1])
    assert not any(200 <= r.doc_id < 300 for r in stages[1])


def test_simhash(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1])
    keep = [rows[i][0] for i, r in enumerate(reachable([simhash(t) for _, t in rows])) if r == i]
    assert sorted(r.doc_id for r in stages[2]) == keep and 500 in keep and 501 not in keep


def test_mix(stages):
    sizes = {}
    for r in stages[2]:
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text))
    got = dict.fromkeys(sizes, 0)
    for r in stages[3]:
        got[r.source] += len(WORD.findall(r.text))
    for s, want in brute_targets(sizes).items():
        assert abs(got[s] - want) <= 1
    texts = {r.doc_id: r.text for r in stages[2]}
    assert sum(r.text != texts[r.doc_id] for r in stages[3]) <= len(sizes)


def test_tokens(stages):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r.doc_id, hashlib.sha256(np.array(lib.encode(r.text, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest())
                  for r in stages[3])
    assert sorted((r.doc_id, r.ids_sha256) for r in stages[4]) == want


def test_boilerplate_lines_go(spark):
    rnd = random.Random(4)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n))

    rows = [(i, f"Home | News\n\n{prose(40)}\n  HOME |  news \n{prose(9)}\n", "en", "a", 0) for i in range(40)]
    rows += [(100 + i, f"Home | News\n{prose(40)}", "en", "b", 0) for i in range(9)]       # rare on its host
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in P.quality_rules(spark, df, "/nowhere").collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        want = text if i >= 100 else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in (0, 3))
        assert got[i].text == want and got[i].n_chars == len(want)


def test_near_copies_are_no_boilerplate(spark):
    rnd = random.Random(8)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n))

    lines = [prose(14) for _ in range(4)]
    rows = [(0, "\n".join(lines), "a")]
    for i in range(1, 60):                              # one word changed in one line of four
        copy = [x.split() for x in lines]
        copy[i % 4][i % 14] = f"changed{i}"
        rows.append((i, "\n".join(" ".join(x) for x in copy), "a"))
    nav = [prose(10) for _ in range(4)]
    rows += [(100 + i, prose(40), "a") for i in range(90)]
    rows += [(200 + i, "\n".join([*nav, prose(12)]), "a") for i in range(40)]           # really mostly boilerplate
    rows += [(300 + i, "\n".join([nav[0], prose(40)]), "a") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in P.quality_rules(spark, df, "/nowhere").collect()}
    for i, text, _ in rows:
        assert got.get(i) == (None if 200 <= i < 300 else text.split("\n")[1] if i >= 300 else text), i


def test_depleted_pages_go_and_near_copies_stay(spark):
    """Pages of boilerplate with few words of their own beside a group of near copies: a third of all rows each."""
    rnd = random.Random(21)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n))

    nav = [prose(12) for _ in range(20)]
    rows = [(i, "\n".join([*nav, prose(20)]), "a") for i in range(100)]                       # one longer line
    rows += [(100 + i, "\n".join([prose(2), *nav]), "a") for i in range(50)]                  # a title only
    rows += [(150 + i, "\n".join([*nav[:10], prose(5), *nav[10:], prose(5)]), "a") for i in range(50)]
    lines = [prose(16) for _ in range(6)]
    for i in range(200):                                # two words changed, in two lines of six
        copy = [x.split() for x in lines]
        copy[i % 6][i % 16] = f"changed{i}"
        copy[(i + 1 + i % 5) % 6][i % 13] = f"other{i}"
        rows.append((200 + i, "\n".join(" ".join(x) for x in copy), "a"))
    rows += [(400 + i, "\n".join(prose(20) for _ in range(3)), "a") for i in range(200)]
    rows += rows[200:220] + rows[:5]                    # repeated rows
    rows.append((700, None, None))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.text) for r in P.quality_rules(spark, df, "/nowhere").collect())
    assert got == sorted((i, text) for i, text, _ in rows if 200 <= i < 700)

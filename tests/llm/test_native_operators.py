"""DataFrame operators against brute force in plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from staysense.llm import doc_winnow, line_quality, line_runs, secret_scan, source_mix, url_templates
from staysense.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return dict(spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect())


# ------------------------------------------------------------------------ op1
def base(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_base_matches_brute_force(spark, texts):
    rows = QUERIES["op1_quality_lines"](spark, SF_CHECK).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert base(texts[r.doc_id]) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_quality_rejects_boilerplate_and_keeps_clean(spark):
    rnd = random.Random(3)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))

    boiler = [prose(12) for _ in range(4)]
    rows = [(i, prose(60), "h") for i in range(60)]
    rows += [(100 + i, "\n".join(boiler + [prose(10)]), "h") for i in range(40)]        # mostly shared lines
    rows += [(200 + i, boiler[0].upper() + " \n" + prose(60), "h") for i in range(20)]   # one shared line
    rows += [(300 + i, "\n".join(boiler[:2] + [prose(30)]), "other") for i in range(3)]  # rare on its host
    copy = prose(80)
    rows += [(400 + i, copy, "h") for i in range(50)]                                    # copies are one document
    got = {r.doc_id: r for r in line_quality.judge(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()}
    for i, r in got.items():
        assert r.kept == (not 100 <= i < 200), i
    assert got[100].removed_words == 48 and got[200].removed_words == 12 and got[300].removed_words == 0


# ------------------------------------------------------------------------ op2
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def test_url_rules_and_parts(spark):
    cases = {"http://WWW.Example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
             "https://m.example.com/en/2?x=/": ("m.example.com", "/en/2", "example.com/en/", "block"),
             "https://notexample.com/en/2#a": ("notexample.com", "/en/2", "com/", "allow"),
             "http://a.net/es/": ("a.net", "/es/", "net/es/", "block"), "http://com": ("com", "", None, "allow"),
             "no scheme/com/": ("", "", None, "allow"), None: ("", "", None, "allow"),
             "x://é.COM/?://b": ("é.com", "/", "com/", "allow"), "http://a.net?q": ("a.net", "", None, "allow")}
    df = spark.createDataFrame(list(enumerate(cases)), "page_id int, url string")
    got = {r.id: r for r in url_templates.judge(df, RULES).collect()}
    for i, want in enumerate(cases.values()):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want


def test_url_templates_reject_bad_branches_only(spark):
    rows, labels = [], []
    for i in range(600):
        kind = ["news", "spam", "junk", "about"][i % 4]
        rows.append((i, f"http://h.org/{kind}/{i}.html"))
        if i % 2 == 0 or kind == "spam":
            labels.append((i, kind in ("spam", "junk")))
    rows += [(1000 + i, f"http://h.org/user-{'abcdefghij'[i % 10]}{chr(97 + i // 10)}x") for i in range(100)]
    out = url_templates.judge(spark.createDataFrame(rows, "page_id int, url string"), [],
                              spark.createDataFrame(labels, "id int, bad boolean")).collect()
    for r in out:
        bad = r.path.startswith(("/spam", "/junk"))
        assert r.verdict == ("block" if bad else "allow"), r
    names = {r.template for r in out}
    assert {"/junk|spam/{n}.html", "/news/{n}.html"} <= names       # alike in their shares, and not
    assert any("*" in n for n in names)                 # too many siblings became one


def test_url_many_labelled_siblings_are_judged_apart(spark):
    rows, labels = [], []
    for k in range(60):                                 # 60 sections of 20 labelled urls, 8 of them all bad
        name = f"part-{'abcdefghij'[k % 10]}{'klmnop'[k // 10]}"
        rows += [(100 * k + i, f"http://h.org/{name}/{i}") for i in range(30)]
        labels += [(100 * k + i, k % 8 == 3) for i in range(20)]
    rows += [(100_000 + i, f"http://h.org/news/{i}") for i in range(40_000)]            # 95 % of the host
    labels += [(100_000 + i, False) for i in range(500)]
    out = url_templates.judge(spark.createDataFrame(rows, "page_id int, url string"), [],
                              spark.createDataFrame(labels, "id int, bad boolean")).collect()
    assert len(out) == len(rows)
    for r in out:
        bad = r.id < 100_000 and r.id // 100 % 8 == 3
        assert r.verdict == ("block" if bad else "allow"), r


def test_url_deep_paths_keep_all_segments(spark):
    deep = "/".join("abcdefghijk")
    rows, labels = [], []
    for i in range(120):
        rows.append((i, f"http://h.org/{deep}/{['good', 'spam'][i % 2]}/{i}.html"))
        labels.append((i, i % 2 == 1))
    rows += [(1000 + i, f"http://h.org/{deep}" + "/x" * 300 * i) for i in range(2)]
    out = url_templates.judge(spark.createDataFrame(rows, "page_id int, url string"), [],
                              spark.createDataFrame(labels, "id int, bad boolean")).collect()
    assert len(out) == len(rows)
    assert {(r.template, r.verdict) for r in out if r.id < 1000} == {
        (f"/{deep}/good/{{n}}.html", "allow"), (f"/{deep}/spam/{{n}}.html", "block")}
    assert {r.template for r in out if r.id >= 1000} == {f"/{deep}", f"/{deep}" + "/x" * 300}


# ------------------------------------------------------------------------ op3
def brute_targets(sizes, share=1.5, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = 2 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mix_targets_and_takings(spark, texts):
    rows = QUERIES["op3_source_mix"](spark, SF_CHECK).collect()
    source = dict(spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "source").collect())
    sizes, got = Counter(), Counter()
    for r in rows:
        assert r.size == len(WORD.findall(texts[r.doc_id])) and 0 <= r.taken <= 2 * r.size
        sizes[source[r.doc_id]] += r.size
        got[source[r.doc_id]] += r.taken
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]] and math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9)
    for s in want:
        assert abs(got[s] - want[s]) <= 1
    again = QUERIES["op3_source_mix"](spark, SF_CHECK).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_of_odd_sources(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(5, "a"), (0, "z"), (3000, None), (1, "é"), (700, "b"), (700, "b"), (90, "c")])]
    rows.append(rows[4])                                # a repeated row
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = source_mix.taken(df).collect()
    sizes = {"a": 5, "z": 0, None: 3000, "é": 1, "b": 2100, "c": 90}
    want = brute_targets(sizes)
    total = Counter()
    for r in got:
        s = dict((x[0], x[2]) for x in rows)[r.doc_id]
        total[s] += r.taken
        assert r.taken <= 2 * r.size and math.isclose(r.target, want[s], rel_tol=1e-9)
    for s in sizes:
        assert abs(total[s] - want[s]) <= 1
    docs = source_mix.mixed_documents(df).collect()
    assert sum(len(r.text.split()) for r in docs) == sum(total.values())


def test_schedule_is_even_at_every_prefix(spark):
    sizes = spark.createDataFrame([(1, "a", 1, 400_000), (2, "b", 2, 200_000), (3, "c", 3, 200_000)],
                                  "doc_id int, source string, key long, size long")
    per = source_mix.targets(sizes)
    share = {r.sr: r.target / sum(x.target for x in per.collect()) for r in per.collect()}
    seen = Counter()
    for n, r in enumerate(source_mix.schedule(spark, per).orderBy("slot").collect(), 1):
        seen[r.sr] += 1
        assert all(abs(seen[s] - n * share[s]) < 6 for s in share)


# ------------------------------------------------------------------------ op4
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(out)


SECRETS = ["", "é日𝄞 token = 'abc123' x AKIA" + "A1" * 8, "token=token:abcdefgh", "API_KEY: zzzzzz;apikey=short passwd=yyyyyyy",
           "AKIAAKIA" + "B" * 16, "f" * 24 + "g" + "0" * 23, "secret : deadbeefdeadbeefdeadbeefdeadbeef", "ſecret=abcdefg tokenK=1234567",
           "blob Zk3xQ9vTr7LmB2nYw8PdJf5HsGc1 end", "id 550e8400-e29b-41d4-a716-446655440000", "word " + "antidisestablishment" * 3,
           "0123456789ABCDEF0123 A7F3C91E5B02D864FA13 A7F3C91E", "/usr/Local2/share/Doc3/readme/Some/Thing4x"]


def test_secret_base_spans(spark, texts):
    every = list(texts.values()) + SECRETS
    df = spark.createDataFrame(list(enumerate(every)), "doc_id int, text string")
    for r in secret_scan.digest(secret_scan.scan(df)).collect():
        want = base_spans(every[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (every[r.doc_id][:80], text, r.spans)
        assert Counter(x[3] for x in want) == Counter(assign=r.n_assign, access=r.n_access, hex=r.n_hex)
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))


def test_entropy_windows_match_counting_anew(spark):
    rnd = random.Random(5)
    c = secret_scan.CLASSES[1]
    runs = ["".join(rnd.choice(c.alphabet if rnd.random() < p else "aA1") for _ in range(rnd.randint(10, 90)))
            for p in (0.1, 0.5, 0.9, 1.0) for _ in range(15)]
    df = spark.createDataFrame([(x,) for x in runs], "run string")
    for r in df.select("run", secret_scan.high_entropy(F.col("run"), c).alias("h")).collect():
        high = [i for i in range(len(r.run) - c.window + 1) if -sum(
            n / c.window * math.log2(n / c.window) for n in Counter(r.run[i:i + c.window]).values()) >= c.threshold - 1e-9]
        want = (high[0], high[-1] + c.window) if high else (-1, -1)
        assert tuple(r.h) == want


def test_entropy_finds_and_allows(spark):
    df = spark.createDataFrame(list(enumerate(SECRETS)), "doc_id int, text string")
    got = {r.doc_id: r for r in secret_scan.scan(df).collect()}
    assert [SECRETS[8][x["start"]:x["end"]] for x in got[8].added] == ["Zk3xQ9vTr7LmB2nYw8PdJf5HsGc1"]
    assert [SECRETS[11][x["start"]:x["end"]] for x in got[11].added] == ["A7F3C91E5B02D864FA13"]
    assert not got[9].added and not got[10].added and not got[12].added
    text = {r.doc_id: r.text for r in secret_scan.redact(secret_scan.scan(df)).collect()}
    assert text[8] == "blob [secret] end" and text[10] == SECRETS[10] and text[6] == "[secret]"


def test_secrets_beside_allowed_spans_and_in_one_case(spark):
    key, uuid = "q7Zk2LmXv9Rt4WbNc8Yp1HsD", "550e8400-e29b-41d4-a716-446655440000"
    lower, upper = "k3v9x2m7q1w8z5t4r6p0y2b7n4", "MZXW6YTBOI7DK3QAPL5VH2SE4N"
    cases = [("https://hooks.org com/services/T02AB3CD4/B05EF6GH7/", key, ""), ("api/v2/keys/", key, " end"),
             ("docs/example/", key, ""), (uuid + "_", key, ""), ("", key, "-" + uuid), ("AKIA" + "A1" * 8 + "/", key, ""),
             ("é𝄞 usr/share/doc/x1/", key, "/usr"), ("key ", lower, "."), ("api/v2/keys/", upper, " end")]
    df = spark.createDataFrame([(i, "".join(c)) for i, c in enumerate(cases)], "doc_id int, text string")
    for r in secret_scan.scan(df).collect():
        before, secret, _ = cases[r.doc_id]
        spans = [r.text[x["start"]:x["end"]] for x in r.added]
        if r.doc_id:
            assert spans == [secret] and r.added[0]["start"] == len(before), (r.text, spans)
        else:
            assert any(secret in x for x in spans)
    plain = ["usr/share/doc/thing/readme1/Abc", uuid, "thisisjustalongwordwithoutdigits", "example/" + uuid, "a" * 30 + "1"]
    df = spark.createDataFrame(list(enumerate(plain)), "doc_id int, text string")
    assert not any(r.added for r in secret_scan.scan(df).collect())


# ------------------------------------------------------------------------ op8
def brute_line_dedup(docs, least=line_runs.MIN_WORDS):
    first, info = {}, {}
    for d, t in sorted(docs):
        lines = t.split("\n")
        seq = [(x.strip(" "), len(WORD.findall(x)), i) for i, x in enumerate(lines) if WORD.search(x)]
        wins = set()
        for a in range(len(seq)):
            for step, stop in ((1, len(seq)), (-1, -1)):
                s = 0
                for b in range(a, stop, step):
                    s += seq[b][1]
                    if s >= least:
                        wins.add((min(a, b), max(a, b)))
                        break
        info[d] = lines, seq, wins
        for a, b in wins:
            k, p = tuple(x[0] for x in seq[a:b + 1]), (d, seq[a][2])
            first[k] = min(first.get(k, p), p)
    out = {}
    for d, (lines, seq, wins) in info.items():
        gone = {i for a, b in wins if first[tuple(x[0] for x in seq[a:b + 1])] < (d, seq[a][2])
                for i in range(seq[a][2], seq[b][2] + 1)}
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_line_dedup_matches_brute_force(spark, texts):
    want = brute_line_dedup(list(texts.items()))
    got = QUERIES["op8_line_dedup"](spark, SF_CHECK).collect()
    assert len(got) == len(texts) and sum(r.n_removed > 0 for r in got) > 50
    for r in got:
        assert r.text == want[r.doc_id]


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_random_runs(spark, seed):
    rnd = random.Random(seed)
    pool = [" ".join(f"w{rnd.randint(0, 5)}" for _ in range(rnd.randint(0, 9))) for _ in range(12)]
    docs = []
    for d in range(40):
        lines = [rnd.choice(pool) for _ in range(rnd.randint(0, 12))]
        if docs and rnd.random() < 0.6:
            old = rnd.choice(docs)[1].split("\n")
            a = rnd.randint(0, len(old) - 1)
            lines[rnd.randint(0, len(lines)):0] = old[a:a + rnd.randint(1, 8)]
        docs.append((d, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id int, text string")
    want = brute_line_dedup(docs, 12)
    for r in line_runs.drop_repeats(df, 12).collect():
        assert r.text == want[r.doc_id]


# ------------------------------------------------------------------------ op10
def grams_of(text):
    w = text.lower().split()
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])


def test_winnowing_keeps_rightmost_minima(spark):
    rnd = random.Random(2)
    texts = ["", "a", "a b c d", "a b c d e", "a " * 50, *[" ".join(rnd.choice("abcd") for _ in range(rnd.randint(5, 60))) for _ in range(30)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    hashed = doc_winnow.gram_hashes(df, "text", "g")
    for r in doc_winnow.winnow(hashed, "g", "fp").collect():
        assert len(r.g) == len(grams_of(texts[r.doc_id]))
        w, want = min(8, len(r.g)), []
        for i in range(len(r.g) - w + 1 if r.g else 0):
            at = min(range(i, i + w), key=lambda j: (r.g[j] >> 31, -j))
            if not want or want[-1][1] != at:
                want.append((r.g[at], at))
        assert [(x["hash"], x["pos"]) for x in r.fp] == want


def test_winnowing_guarantees_shared_runs(spark):
    rnd = random.Random(9)

    def prose(n):
        return " ".join(f"v{rnd.randint(0, 10 ** 6)}" for _ in range(n))

    shared = [prose(12) for _ in range(30)]         # w + k - 1 words
    rows = [(i, f"{prose(20)} {s} {prose(rnd.randint(0, 30))}", f"{prose(rnd.randint(0, 9))} {s} {prose(15)}") for i, s in enumerate(shared)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    df = doc_winnow.fingerprint(doc_winnow.fingerprint(df, "a", "fa"), "b", "fb")
    for r in df.collect():
        assert {x["hash"] for x in r.fa} & {x["hash"] for x in r.fb}


def test_edited_texts(spark, texts):
    order = sorted(texts)
    follows = dict(zip(order, order[1:] + order[:1]))
    rows = QUERIES["op10_doc_fingerprints"](spark, SF_CHECK).collect()
    assert len(rows) == len(texts)
    by_text = defaultdict(set)
    for r in rows:
        t, nxt = texts[r.doc_id], texts[follows[r.doc_id]]
        h = len(t) // 2
        edited = t[:len(t) - h] + nxt[:h]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[t].add(r.fingerprint)
        if t == nxt:
            assert r.near_next == 1
    assert all(len(v) == 1 for v in by_text.values())


def test_next_rows_over_many_ranges(spark):
    ids = [*range(0, 5000, 3), *[7] * 40, None, None]
    df = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(ids)], "doc_id long, text string").repartition(7)
    rows = doc_winnow.with_next(df, ["text"], bucket_rows=50).collect()
    order = sorted(((i is not None, i or 0, f"t{n}") for n, i in enumerate(ids)))
    want = {order[i][2]: order[(i + 1) % len(order)][2] for i in range(len(order))}
    assert {r.text: r.next_text for r in rows} == want and len(rows) == len(ids)

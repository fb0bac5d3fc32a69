"""Personal data and secrets against the plain patterns of their contracts."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from skylattice.llm import _spans, pii, secret_scan
from tests_llm_data import SF


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain_pii(text):
    out = []
    for n, (kind, pattern) in enumerate(
        [
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
        ]
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                kind == "email"
                or (kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 10 <= len(digits) <= 15)
            )
            if good:
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def plain_secrets(text):
    out = []
    for n, (kind, pattern) in enumerate(
        [
            ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
            ("access", r"AKIA[A-Z0-9]+"),
            ("hex", r"[0-9a-f]+"),
        ]
    ):
        for m in re.finditer(pattern, text):
            if {"assign": 6, "access": 20, "hex": 24}[kind] <= len(m[2] if kind == "assign" else m[0]):
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def shown(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def scraps(seed):
    rnd = random.Random(seed)
    bits = ["a@b.c", "x.y@ho-st.co.uk", "a@b.c_d@e.f", "_d@e.f", "@", ".", "1.2.3.4", "256.1.1.1", "001.002.3.255.7", "4111111111111111", "4111 1111-1111 1111", "5 ", "0", "12345678901234567890"]
    bits += ["+1 (555) 555-0100", "+49 30 123456", "+1-2", "++12345678901", "é", "🎉", " ", "  ", "-", "\n", "(", ")", "token = \"abcdef\"", "TOKEN:abc", "secret:token = abcdefgh", "api_key==x", "apikey='AKIA", "AKIA"]
    bits += ["ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "PassWd : zzzzzzz", "ſecret=abcdefgh", "password", "=", ":", "7992739871", "3"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.choice([2, 8, 40]))) for _ in range(700)]


@pytest.fixture(scope="module")
def trees(spark):
    return pii.fit(spark, sample_rows=600)


def rows_of(spark, odd, which):
    if which == "scraps":
        return spark.createDataFrame([(k, t, "o") for k, t in enumerate(scraps(3))], "doc_id long, text string, source string")
    return odd if which == "odd" else spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("which", ["scraps", "odd", "table"])
def test_pii_base_spans_are_the_plain_ones(spark, odd, trees, which):
    docs = rows_of(spark, odd, which)
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in pii.digests(docs, trees).collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        want = plain_pii(text)
        own = [s for s in got[k].spans.split(",") if s.split(":")[0] in pii.BASE]
        assert ",".join(own) == shown(want), text
        assert got[k].base_sha256 == hashlib.sha256(shown(want).encode()).hexdigest()
        for n, kind in enumerate(pii.BASE):
            assert got[k][f"n_{kind}"] == sum(s[1] == n for s in want)


@pytest.mark.parametrize("which", ["scraps", "odd", "table"])
def test_secret_base_spans_are_the_plain_ones(spark, odd, which):
    docs = rows_of(spark, odd, which)
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in secret_scan.digests(docs).collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        want = plain_secrets(text)
        own = [s for s in got[k].spans.split(",") if s.split(":")[0] in secret_scan.BASE]
        assert ",".join(own) == shown(want), text
        assert got[k].base_sha256 == hashlib.sha256(shown(want).encode()).hexdigest()
        for n, kind in enumerate(secret_scan.BASE):
            assert got[k][f"n_{kind}"] == sum(s[1] == n for s in want)


def test_long_runs_do_not_break_the_patterns(spark, trees):
    runs = ["1" * 200_000, "1 " * 100_000, "a" * 200_000, "a." * 100_000 + "@", "1." * 100_000, "+1" + "(" * 100_000, "a@b" + ".c" * 100_000, "f" * 200_000, "token" + " " * 100_000 + "x"]
    docs = spark.createDataFrame([(k, t, "o") for k, t in enumerate(runs)], "doc_id long, text string, source string")
    assert pii.digests(docs, trees).count() == len(runs)
    emails = {r.doc_id: r.n_email for r in pii.digests(docs, trees).collect()}
    assert emails[6] == 1 and emails[3] == 0
    assert {r.doc_id: r.n_hex for r in secret_scan.digests(docs).collect()}[7] == 1


def test_trees_tell_formats_in_context(spark, trees):
    lines = [
        ("please call 415-555-2671 today", "phone_local"),
        ("my ssn is 123-45-6789", "national_id"),
        ("write to jane [at] corp [dot] org", "email_spelt"),
        ("IBAN DE89370400440532013000", "iban"),
        ("device address 3c:5a:b4:0f:aa:e1", "hardware"),
        ("order 415-555-2671 shipped", ""),
        ("part no 123-45-6789", ""),
        ("ratio 10:20:30:40:50:60", ""),
        ("nothing to see here", ""),
    ]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: {s.split(":")[0] for s in r.spans.split(",") if s} for r in pii.digests(docs, trees).collect()}
    assert [got[k] for k in range(len(lines))] == [{kind} - {""} for _, kind in lines]


def test_trees_hold_their_precision_on_another_sample(spark):
    trees = pii.fit(spark)
    rows = pii.labelled_sample(1200, 99)
    docs = spark.createDataFrame([(k, t) for k, (_, t, _) in enumerate(rows)], "doc_id long, text string")
    hit = wrong = true = 0
    for r in pii.digests(docs, trees).collect():
        kind, _, label = rows[r.doc_id]
        found = any(s.split(":")[0] == kind for s in r.spans.split(","))
        true += label
        hit += found and label
        wrong += found and not label
    assert hit / (hit + wrong) > 0.9 and hit / true > 0.6


def test_redaction(spark, trees):
    docs = spark.createDataFrame([(1, "héllo a@b.co and 10.0.0.1!", "k"), (2, None, "k"), (3, "plain", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.text for r in pii.redacted(docs, trees).collect()}
    assert got == {1: "héllo [EMAIL] and [IP]!", 2: None, 3: "plain"}


def test_many_matches_have_right_places(spark):
    text = " ".join(f"u{k}@h{k}.org" for k in range(1000))
    got = spark.createDataFrame([(text,)], "text string").select(_spans.matches(F.col("text"), pii.EMAIL).alias("m")).first().m
    assert [(s.begin, s.stop) for s in got] == [m.span() for m in re.finditer(r"\S+", text)]


def test_ownership_separates_copies_from_live_values(spark, empty):
    shared, own = "ghp_" + "A1b2" * 8, "ghp_" + "Zz99" * 8
    rows = [(k, f"key {shared} here", f"owner{k}") for k in range(5)] + [(9, f"key {own} here", "owner1"), (9, f"key {own} here", "owner1"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r.doc_id, r.spans, r.n_live, r.n_found) for r in secret_scan.digests(docs).collect()]
    assert sorted(got, key=str) == sorted([(k, "", 0, 1) for k in range(5)] + [(9, "forge_token:4:40", 1, 1)] * 2 + [(None, "", 0, 0)], key=str)
    assert secret_scan.digests(empty).count() == 0


def test_pii_of_nothing(empty, trees):
    assert pii.digests(empty, trees).count() == 0


def plain_candidates(text):
    return [(m.start(), len(secret_scan.BASE) + n, m.end(), kind, m[0]) for n, (kind, pattern) in enumerate(secret_scan.CANDIDATES.items()) for m in re.finditer(pattern, text, re.A)]


def secret_scraps(seed):
    rnd = random.Random(seed)
    bits = ["ghp_" + "a1B2" * 6, "ghp_" + "Zx" * 150, "xoxb-" + "12ab-" * 3, "sk-live-" + "q9" * 12, "sk_" + "w" * 400, "AIza" + "x" * 35, "AIza" + "x" * 36, "eyJ" + "h" * 9 + "." + "p" * 12 + "." + "s" * 10]
    bits += ["eyJ" + "h" * 2100 + "." + "p" * 4200 + "." + "s" * 1100, "-----BEGIN PRIVATE KEY-----", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN OPENSSH NEW PRIVATE KEY-----", "https://me:secret12@host", "ftp://" + "u" * 90 + ":" + "p" * 200 + "@h"]
    bits += [" ", " ", "\n", "x", "é", "🎉", ".", "://", ":", "@", "gh", "eyJ"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.choice([1, 3, 8]))) for _ in range(250)]


def test_added_secrets_are_the_plain_ones_that_few_hold(spark):
    rows = [(k, t, f"o{k % 3}") for k, t in enumerate(secret_scraps(2))] + [(900 + k, "see ghp_" + "Q7" * 15, "o1") for k in range(30)] + [(950, "https://only:" + "here9" * 50 + "@x eyJ" + "k" * 3000 + "." + "l" * 20 + "." + "m" * 20, "o2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    owners, repos = {}, {}
    for k, t, o in rows:
        for *_, value in [*plain_candidates(t), *[(0, 0, 0, "", t[a:b]) for a, _, b, kind in plain_secrets(t) if kind != "assign"]]:
            owners.setdefault(value, set()).add(o)
            repos.setdefault(value, set()).add(k)
    got = {r.doc_id: r.spans for r in secret_scan.digests(docs).collect()}
    for k, t, _ in rows:
        live = [s[:4] for s in plain_candidates(t) if len(owners[s[4]]) <= secret_scan.MAX_OWNERS and len(repos[s[4]]) <= secret_scan.MAX_REPOS]
        assert got[k] == shown(sorted([*plain_secrets(t), *live], key=lambda s: s[:3])), t
    assert not any("forge_token" in got[900 + k] for k in range(30))  # one owner, but copied into many repositories
    assert any("forge_token" in s for s in got.values()) and any("web_token" in s for s in got.values()) and any("url_password" in s for s in got.values())


def plain_features(text, n, kind, m):
    found, before = m[0], text[max(0, m.start() - 40) : m.start()]
    digits = re.sub("[^0-9]", "", found)

    def has(pattern, s):
        return re.search(pattern, s, re.A) is not None

    if kind == "iban":
        bare = found.replace(" ", "")
        valid = int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    elif kind == "national_id":
        valid = not has("^(?:000|666|9)", found) and not has("00[- ][0-9]{4}$|0000$", found)
    elif kind == "phone_local":
        valid = has("^(?:0[1-9]|[2-9])", digits) and 8 <= len(digits) <= 12
    elif kind == "email_spelt":
        valid = has(r"(?:\.|\bdot\b[\])]?\x20?)[A-Za-z]{2,12}$", found) and has(r"[\[(]|\bdot\b", found)
    else:
        valid = not has("^(?:[0-9]{2}[:-]){5}[0-9]{2}$", found)
    flags = [has(pii._FOR, before), has(pii._AGAINST, before), valid, has(r"[\[(]", found), has("-", found) and has(r"[.\x20]", found), has(r"^([0-9])\1*$", digits), has(r"[0-9][^A-Za-z]*$", before)]
    return [n, len(digits), len(found), *map(int, flags)]


def test_added_personal_data_is_what_the_trees_take(spark, trees):
    rnd = random.Random(12)
    sentences = [t for _, t, _ in pii.labelled_sample(400, 5)]
    texts = [" ".join(rnd.choice(sentences) for _ in range(rnd.choice([1, 2, 5]))) + rnd.choice(["", ".", " é🎉"]) for _ in range(300)]
    texts += ["write to " + "x" * 300 + " at " + "y" * 90 + " dot a dot b dot c dot d dot e dot com"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    taken = 0
    for r in pii.digests(docs, trees).collect():
        text, want = texts[r.doc_id], plain_pii(texts[r.doc_id])
        for n, (kind, pattern) in enumerate(pii.GENERATORS.items(), len(pii.BASE)):
            for m in re.finditer(pattern, text, re.A):
                if trees.score_row(plain_features(text, n, kind, m)) >= trees.thresholds[n]:
                    want.append((m.start(), n, m.end(), kind))
        taken += len(want)
        assert r.spans == shown(sorted(want)), text
    assert taken > 200

"""The methods against brute force, round trips and hand-made cases."""

import itertools
import json
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixcorpus.operators.graph import Forest, spanning_forest
from fixcorpus.llm import capping, components, mixing, mojibake, nearedit, packing, personal, residue, secrets, truncation


# ------------------------------------------------------------------ 1


@pytest.mark.parametrize("line, label", [
    ('token = "gh' + "p_" + "aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3z" + '"', 1), ("password: river-engine-canvas-16", None), ("admin_pwd = 'Zebra$anchor7'", 1), ('API_KEY = "xxxxxxxxxxxxxxxx"', 0), ("token: \"<YOUR_TOKEN_HERE>\"", 0),
    ('const account = "xpub' + "A1b2C3d4" * 12 + '"', 0), ('"integrity": "sha512-' + "Ab1+" * 20 + '"', 0), ("DSN = 'postgres://ops:OYU19UX5nung@db/x'", 1), ("secret_key = os.environ['X']", None),
])
def test_weak_labels(line, label):
    found = [secrets.weak_label(*p[:4])[0] for p in secrets.pieces(line) if secrets.worth(*p[:3])]
    assert (max((x for x in found if x is not None), default=None) == label) if label is not None else 1 not in found or "river" in line


def test_split_literal_key_block_and_phrase():
    code = 'const id = "AK" + "IAPG3WTO7E" +\n  "34V5JRST";\nSEED_PHRASE=copper quiet garlic falcon forest yonder lemon lantern temple acorn glade basin\n-----BEGIN EC PRIVATE KEY-----\n' + "A" * 64 + "\n-----END EC PRIVATE KEY-----\nlet seed: [u8; 32] = [" + ", ".join(["0xb9"] * 32) + "];"
    found = {(p[0], secrets.weak_label(*p[:4])[0]) for p in secrets.pieces(code)}
    assert {("joined", 1), ("words", 1), ("pem", 1), ("bytes", 1)} <= found


@pytest.mark.parametrize("code, name, value", [
    ('const password =\n    "S3cr3t!pw9";', "password", "S3cr3t!pw9"), ('map.put("db.password", "S3cr3t!pw9");', "db.password", "S3cr3t!pw9"), ("<password>S3cr3t!pw9</password>", "password", "S3cr3t!pw9"), ('login("admin", "S3cr3t!pw9")', "login", "S3cr3t!pw9"),
    ('password = "48291736"', "password", "48291736"), ('passphrase: "correct horse battery staple"', "passphrase", "correct horse battery staple"), ("SEED: [u8; 32] = [\n  0x1a, " + "0x2b, " * 20 + "\n]", "SEED", None), ('password = "' + "aB3!" * 300 + '"', "password", "aB3!" * 300),
])
def test_places_of_values(code, name, value):
    found = [p for p in secrets.pieces(code) if secrets.worth(*p[:3])]
    if "login" not in code:
        assert any(p[1] == name and (value is None or p[2] == value) for p in found)
    for p in found:
        assert p[0] in ("joined", "pem") or code[p[4][0][0] : p[4][0][1]] == p[2]


def _all_of(*values):
    return lambda rows: np.array([r[2] in values or r[0] in ("pem", "bytes") for r in rows])


def _masked(code, *values, file="a.py"):
    doc = json.dumps([{"file": "first.ts", "hunks": []}, {"file": file, "hunks": [{"start_line": 3, "code": code}]}])
    out, n = secrets.masked(doc, _all_of(*values))
    again = json.loads(out)
    assert n > 0 and [e["file"] for e in again] == ["first.ts", file] and again[1]["hunks"][0]["start_line"] == 3
    return again[1]["hunks"][0]["code"]


def test_masking_goes_by_position():
    m = secrets.MASK
    assert _masked('pw = "T4m\\"per!é88"\n# done ☃ 😀', 'T4m\\"per!é88', file="é.py") == f'pw = "{m}"\n# done ☃ 😀'
    assert _masked("password = 'admin1'\nuser = admin1_user", "admin1", file="admin1.py") == f"password = '{m}'\nuser = admin1_user"
    assert _masked("token = 'abcdefgh12345678'\nlog('abcdefgh12345678')\nabcdefgh12345678x()", "abcdefgh12345678") == f"token = '{m}'\nlog('{m}')\nabcdefgh12345678x()"
    block = "-----BEGIN EC PRIVATE" + " KEY-----\n" + "Ab1+" * 16 + "\nqQ==\n-----END EC PRIVATE" + " KEY-----\nrest = 1"
    assert _masked(block) == f"-----BEGIN EC PRIVATE KEY-----\n{m}\n{m}\n-----END EC PRIVATE KEY-----\nrest = 1"
    numbers = "seed = [" + ", ".join(["0x1f"] * 16) + "]; n = 2"
    assert _masked(numbers) == "seed = [" + ", ".join(["0x00"] * 16) + "]; n = 2"
    assert _masked("id = 'Ab' + 'cd9'", "Abcd9") == f"id = '{m}' + '{m}'"


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), st.text(alphabet=st.characters(codec="utf-8"), max_size=40))
def test_masking_keeps_everything_else(before, after):
    secret = "Zq8#kLmN42xv"
    code = f"{before}\npassword = \"{secret}\"\n{after}"
    doc = json.dumps([{"file": before, "hunks": [{"start_line": 1, "code": code}]}], ensure_ascii=len(before) % 2 == 0)
    out, _ = secrets.masked(doc, lambda rows: np.array([r[2] == secret for r in rows]))
    if any(p[2] == secret for p in secrets.pieces(code)):
        assert json.loads(out) == [{"file": before, "hunks": [{"start_line": 1, "code": code.replace(secret, secrets.MASK)}]}]


def test_the_regression_judges_patterns_it_was_not_shown(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/wallet_vulns.parquet")
    got = secrets.hidden_patterns(secrets.scanned(table))
    by = {"mixed under a secret name", "64 hex digits", "expression", "harmless name"} & set(got)
    assert by and all(got[p][1] >= 0.7 for p in by), got


def test_broken_documents_give_what_can_be_read():
    got = secrets.entries('[{"file": "a.py", "hunks": [{"start_line": 1, "code": "x = 1\\ny"}]}, {"file": "b.py", "hunks": [{"start_line": 2, "code": "cut of')
    assert got == [("a.py", "x = 1\ny"), ("b.py", "cut of")]


# ------------------------------------------------------------------ 2


def _brute(rows, threshold=0.5):
    word = re.compile("[a-z0-9]+")
    sets = {}
    for i, t, d, u in rows:
        if len(word.findall((d or "").lower())) >= 30:
            w = word.findall(f"{t or ''} {d or ''} {u or ''}".lower())
            sets[i] = set(zip(w, w[1:], w[2:]))
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(28, 60))]
        for v in range(rng.randint(1, 4)):
            x = list(base)
            for _ in range(rng.randint(0, 7)):
                x[rng.randrange(len(x))] = rng.choice(words)
            rows.append((f"{k:02d}-{v}", None if k % 9 == 0 else f"T {k}", " ".join(x), f"http://h/{k}"))
    common = "the same long sentence stands in very many of these records and makes their buckets large so that they must be split again and again until"
    rows += [(f"c{i:03d}", "", f"{common} number {i} {rng.random()} {rng.choice(words)}", "") for i in range(80)]
    df = spark.createDataFrame(rows, "id string, title string, description string, source_url string")
    got = {(r["id_a"], r["id_b"]) for r in nearedit.near_pairs(df).collect()}
    want = _brute(rows)
    assert not got - want and len(want & got) >= 0.995 * len(want) and len(want) > 2000


def test_large_buckets_are_split_and_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearedit, "BLOCKS", 1)
    text = " ".join(f"common{i}" for i in range(60))
    n = nearedit.BUCKET + 40
    df = spark.createDataFrame([(f"{i:04d}", "", f"{text} end{i}", "") for i in range(n)], "id string, title string, description string, source_url string")
    assert nearedit.class_pairs(df)[0].count() == n * (n - 1) // 2


def _planted(n, lead, both, first, second):
    """Rows of n pairs of records (lead words in all, own words in both, in the first, in the second) and the pairs at the threshold."""
    rows, pairs = [], set()
    for i in range(n):
        x, y = (" ".join([f"lead{k}" for k in range(lead)] + [f"b{i}x{k}" for k in range(both)] + [f"{s}{i}x{k}" for k in range(m)]) for s, m in (("p", first), ("q", second)))
        rows += [(f"{i:05d}p", "", x, ""), (f"{i:05d}q", "", y, "")]
        pairs |= _brute(rows[-2:])
    return rows, pairs


def test_a_record_and_its_longer_copy_meet(spark):
    # similarity 38 / 76
    rows, want = _planted(4000, 0, 40, 0, 38)
    assert len(want) == 4000
    got = {(r["id_a"], r["id_b"]) for r in nearedit.near_pairs(spark.createDataFrame(rows, "id string, title string, description string, source_url string").repartition(4)).collect()}
    assert not got - want and len(got) >= 0.9975 * len(want)


@pytest.mark.parametrize("blocks", [nearedit.BLOCKS, 1])
def test_pairs_under_shared_boilerplate_are_kept(spark, monkeypatch, blocks):
    monkeypatch.setattr(nearedit, "BLOCKS", blocks)
    rows, want = _planted(5000, 16, 18, 16, 16)
    assert len(want) == 5000
    got = {(r["id_a"], r["id_b"]) for r in nearedit.near_pairs(spark.createDataFrame(rows, "id string, title string, description string, source_url string").repartition(4)).collect()}
    assert not got - want and len(got) >= 0.9975 * len(want)


def test_many_copies_meet_once(spark):
    text = " ".join(f"word{i}" for i in range(50))
    n = nearedit.COPIES_AS_PAIRS + 50
    df = spark.createDataFrame([(f"{i:04d}", "", text, "") for i in range(n)] + [("z", "", text + " more", "")], "id string, title string, description string, source_url string")
    got = {(r["id_a"], r["id_b"]) for r in nearedit.near_pairs(df).collect()}
    assert got == {("0000", f"{i:04d}") for i in range(1, n)} | {("0000", "z")}
    every = {(r["id_a"], r["id_b"]) for r in nearedit.near_pairs(df, copies_as_pairs=None).collect()}
    assert every == set(itertools.combinations([*(f"{i:04d}" for i in range(n)), "z"], 2))
    groups = nearedit.near_groups(df).collect()
    assert len(groups) == n + 1 and {r["group_id"] for r in groups} == {"0000"}


# ------------------------------------------------------------------ 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=80))
def test_spanning_forest(edges):
    a, b = np.array(edges).T
    nodes, roots = spanning_forest(a, b)
    label = {n: n for n in nodes.tolist()}
    for _ in range(len(label)):
        for x, y in edges:
            label[x] = label[y] = min(label[x], label[y])
    assert dict(zip(nodes.tolist(), roots.tolist())) == label


def test_groups_through_many_levels(spark):
    rng = random.Random(8)
    rows = [(f"{i:04d}", f"a{rng.randrange(700)}", f"b{rng.randrange(500)}" if i % 3 else None) for i in range(900)] + [(f"h{i}", "hub", None) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, a string, b string").repartition(12)
    got = {r["id"]: (r["group_id"], r["group_size"]) for r in components.link_groups(df, "id", [F.col("a"), F.col("b")], edges_per_partition=20).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a, b in rows:
        for k in (("a", a), ("b", b)):
            if k[1] is not None:
                parent[find(k)] = find(i)
    groups = {}
    for i, _, _ in rows:
        groups.setdefault(find(i), []).append(i)
    assert got == {i: (min(g), len(g)) for g in groups.values() if len(g) > 1 for i in g}


# ------------------------------------------------------------------ 4


def test_cap_keeps_the_best_and_ranks_ties_by_id(spark):
    rng = random.Random(2)
    rows = [(f"{rng.randrange(10**6):06d}", "Big " if i % 2 else f"s{i % 50}", rng.choice(["high", " HIGH", "low", None, "odd"]), rng.choice([0.5, None, 0.9])) for i in range(800)]
    df = spark.createDataFrame(rows, "id string, source_platform string, confidence string, security_score double")
    cap = 800 * 25 // 1000
    rank = {"high": 0, "medium": 1, "low": 2}
    want = set()
    by = {}
    for r in rows:
        by.setdefault(r[1].strip().lower(), []).append(r)
    for g in by.values():
        g.sort(key=lambda r: (rank.get((r[2] or "").strip().lower(), 3), -r[3] if r[3] is not None else 1, r[0]))
        want |= {r[0] for r in g[cap:]}
    got = {r["id"] for r in capping.platform_cap(df).filter("not kept").collect()}
    assert got == want


def test_even_slots_hand_spare_ones_on(spark):
    rows = [(f"a{i}", "p", "2020", 0.1) for i in range(2)] + [(f"b{i}", "p", "2021", 0.1) for i in range(50)] + [(f"c{i}", "p", "2022", 0.1) for i in range(50)]
    df = spark.createDataFrame(rows, "id string, source_platform string, y string, s double")
    out = capping.cap_contributors(df, "id", F.col("source_platform"), F.col("y"), [F.col("s")], F.lit(21), even=True)
    kept = {r["stratum"]: r["n"] for r in out.filter("kept").groupBy("stratum").agg(F.count("*").alias("n")).collect()}
    assert kept == {"2020": 2, "2021": 10, "2022": 9}


# ------------------------------------------------------------------ 5


@pytest.mark.parametrize("text, bad", [
    ("Page not found", True), ("Error 502: bad gateway. Request id 0f3e9a11", True), ("The patch is fine. Please enable JavaScript and cookies to continue.", True), ("## Summary\n\n<!-- what and why? -->\n\n## Test plan\n\n- [ ] \n", True),
    ("In {{file}} the {{function}} is affected by {{issue}}.", True), ("Fuzzing <function name> for <number> minutes", True), ("Lorem ipsum vero labore magna.", True), ("The vault crashes when {{component}} is closed twice by the user.", True),
    ("Escape {{name}} and ${amount} before the page is drawn, so that no markup gets in.", False), ("The server answered 502 and the client asked again 12 times before it gave up.", False), ("Users with access denied see the reason in the log now.", False), ("The placeholder {{name}} is replaced twice.", False),
    ("<!-- keep this line --> The flag in a/b.rs turned closeWorkerPin off for version 7.21.17.", False), ("## Steps to reproduce\nOpen the vault twice and wait.\n\n## Expected\nNo crash of the signer.", False), ("Vec<String> and Map<u8, u8> are parsed twice here.", False),
    ("the handler interpolates {user} into the query that the driver runs", False), ("The sample text in lorem style ran over the edge.", False),
])
def test_residue(text, bad):
    w = residue.Weigher({"": 100_000, "the": 40_000, "in": 20_000, "a": 20_000, "to": 9_000, "and": 9_000, "is": 12_000, "when": 5_000, "for": 9_000, "SLOT": 90, "NAME": 60_000, "0": 40_000, "minutes": 800, "by": 9_000})
    assert w.is_residue(text) is bad


# ------------------------------------------------------------------ 6


def test_cut_values(spark):
    rng = random.Random(4)
    nouns = ["router", "parser", "vault", "signer", "cache", "panel"]

    def sentence():
        return f"The {rng.choice(nouns)} keeps the session alive until the {rng.choice(nouns)} closes the pending request on a cold start."

    rows = [(f"{i:04d}", " ".join(sentence() for _ in range(rng.randint(1, 4))) + rng.choice(["", "\nFixes #12", "\nTracked in WF-99"]), None, None) for i in range(600)]
    whole = json.dumps([{"file": "a", "hunks": [{"start_line": 1, "code": "let a = 1;\nlet b = 2;"}]}])
    cut = {"x1": "The router keeps the session alive until the par", "x2": "The vault keeps the", "x3": "All is fine. The signer keeps [...]", "x4": "All is fine. The cache keeps the session…"}
    rows += [(k, v, whole, whole[:-9]) for k, v in cut.items()] + [("ok", "The panel keeps the session alive until the signer closes the pending request on a cold start", whole, "[]")]
    df = spark.createDataFrame([(*r[:1], f"title {r[0]}", *r[1:]) for r in rows], "id string, title string, description string, pre_fix_code string, post_fix_code string")
    got = {(r["id"], r["field_name"]) for r in truncation.cut_values(df)[0].collect()}
    assert got == {(k, "description") for k in cut} | {(k, "post_fix_code") for k in cut}


def test_copies_of_a_cut_value_and_of_a_form(spark):
    """A cut value filed many times is cut in every copy; a form's last line under many titles is complete."""
    rng = random.Random(5)
    rows = [(f"{i:04d}", f"title {i}", f"The {rng.choice(['router', 'vault', 'panel'])} number {i} keeps the session alive until the signer closes it. See the checklist below.") for i in range(300)]
    rows += [(f"c{i:03d}", "the same fix", "The vault keeps the session alive until the") for i in range(100)]
    rows += [(f"f{i:03d}", f"form {rng.random()}", "Please tick the checklist") for i in range(60)]
    df = spark.createDataFrame(rows, "id string, title string, description string").withColumns({c: F.lit(None).cast("string") for c in ("pre_fix_code", "post_fix_code")})
    got = {r["id"] for r in truncation.cut_values(df)[0].collect()}
    assert got == {f"c{i:03d}" for i in range(100)}


def test_values_at_a_limit_are_decided_there(spark):
    rng = random.Random(6)
    words = [f"w{rng.choice('abcdefgh')}{i}x" for i in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 90))) + "." for _ in range(1500)]
    rows = [(f"{i:04d}", f"title {i} {rng.random()}", t) for i, t in enumerate(texts)]
    rows += [(f"k{i:03d}", f"other {i} {rng.random()}", t[:150]) for i, t in enumerate(t for t in texts if len(t) > 200) if i < 80]
    df = spark.createDataFrame(rows, "id string, title string, description string").withColumns({c: F.lit(None).cast("string") for c in ("pre_fix_code", "post_fix_code")})
    cut, limits = truncation.cut_values(df)
    assert (0, 150) in {(r["measure"], r["length"]) for r in limits.collect()}
    got = {r["id"]: r["reason"] for r in cut.collect()}
    assert len([k for k in got if k[0] == "k"]) >= 76 and {v for k, v in got.items() if k[0] == "k"} == {"at a storage limit"}


def test_lengths_under_other_encodings():
    chars, utf8, utf16, entities, js, crlf, crlf8 = truncation.lengths('é<"\n😀')
    assert (chars, utf8, utf16, entities, js, crlf, crlf8) == (5, 9, 6, 5 + 3 + 5, 5 + 2, 6, 10)


# ------------------------------------------------------------------ 7

LEXICON = [(a + b, "given") for a in ("Bre", "Jo", "Ko", "Mi") for b in ("bekh", "mira", "naq", "rik")] + [(a + b, "family") for a in ("Fair", "Harr", "Kol") for b in ("quist", "owicz", "sinek")]


@pytest.mark.parametrize("text, kinds", [
    ("Reporter: Jomira Fairquist, jo.f@mail.example", {"name", "email"}), ("Mail to security@x.example is not needed.", set()), ("Clone it from git@git.x.example:quill/a.git to reproduce.", set()), ("Pin @quillsafe/rotate@1.2.3 until then.", set()),
    ("Call +1 (303) 555-0163 after six.", {"phone"}), ("The device was shipped to 323 Tannery Drive\nKirrowby 66320.", {"address"}), ("Return it to Weidenweg 5, 98613 Finsterau-See.", {"address"}), ("Sent to P.O. Box 96, Sandle Bay.", {"address"}),
    ("Contact: bkoloyan at corp dot invalid", {"email"}), ("Street mode in the map is off.", set()), ("The node at 10.28.26.42 returned 9892 rows.", set()), ("Grace Period and Quiet Hours are labels.", set()),
])
def test_items_by_form(text, kinds):
    names = personal.Names(LEXICON)
    assert {k for _, _, k, bits, _ in personal.candidates(text, names) if bits >= personal.DISCLOSURE} == kinds


def test_cues_tell_numbers_apart(spark):
    rows = [(f"p{i}", None, f"The reporter can be called on +49 30 23125 {i:03d}.") for i in range(40)] + [(f"q{i}", None, f"The reporter can be called on 202-555-0{i:03d}.") for i in range(10)]
    rows += [(f"t{i}", None, f"Ticket 202-555-0{i:03d} has the trace.") for i in range(30)] + [(f"s{i}", "leaks passport Z0348670" + str(i % 10), None) for i in range(20)] + [(f"n{i}", None, "Build Z0348670" + str(i % 10) + " has the defect.") for i in range(20)]
    df = spark.createDataFrame(rows, "id string, title string, description string")
    lex = spark.createDataFrame(LEXICON, "name_word string, name_kind string")
    got = {(r["id"][0], r["pii_kind"]) for r in personal.personal_items(df, lex).collect()}
    assert got == {("p", "phone"), ("q", "phone"), ("s", "id_number")}
    clean = {r["id"]: r for r in personal.sanitised(df, lex).collect()}
    assert clean["p0"]["description"] == "The reporter can be called on <PHONE>." and clean["t0"]["description"].startswith("Ticket 202")


def test_parts_tell_names_that_no_lexicon_has(spark):
    """A surname that stands beside known names elsewhere is one alone; a common word with a capital is none."""
    rows = [(f"a{i}", None, f"It was found by {g} Quandorp on host {i}.") for i, g in enumerate(["Brebekh", "Jomira", "Konaq", "Mirik"] * 8)]
    rows += [(f"b{i}", None, f"It was found by {g} {f} on host {i}.") for i, (g, f) in enumerate([("Brebekh", "Fairquist"), ("Jomira", "Harrowicz"), ("Konaq", "Kolsinek")] * 8)]
    rows += [(f"c{i}", None, f"The Ledger was slow by Ledger {i}.") for i in range(30)] + [("x", None, "It was found by Quandorp on host 7."), ("y", None, "It was slow by Ledger again.")]
    df = spark.createDataFrame(rows, "id string, title string, description string")
    lex = spark.createDataFrame(LEXICON, "name_word string, name_kind string")
    got = {r["id"] for r in personal.personal_items(df, lex).collect()}
    assert "x" in got and "y" not in got and not any(i[0] == "c" for i in got) and all(f"a{i}" in got for i in range(32))


def test_mail_is_judged_by_what_stands_around_it(spark):
    """Addresses where mailboxes of functions stand otherwise say less than those after a reporter's name."""
    rows = [(f"a{i}", None, f"Reported by jomira.f{i}@post.example on Monday.") for i in range(20)] + [(f"b{i}", None, f"Clone over git@host{i}.example to reproduce it.") for i in range(40)]
    rows += [("x", None, "Reported by kk77@post.example on Monday."), ("y", None, "Clone over kk77@host3.example to reproduce it.")]
    df = spark.createDataFrame(rows, "id string, title string, description string")
    got = {r["id"]: r["bits"] for r in personal.personal_items(df, spark.createDataFrame(LEXICON, "name_word string, name_kind string"), disclosure=-50).filter("pii_kind = 'email'").collect()}
    assert got["x"] >= personal.DISCLOSURE > got["y"] and all(got[f"a{i}"] >= personal.DISCLOSURE for i in range(20)) and not any(k[0] == "b" for k in got)


# ------------------------------------------------------------------ 8


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
def test_plan_places_every_item_once(counts):
    used = {}
    for pattern, n in packing.plan(counts, 50):
        assert sum(s * k for s, k in pattern) <= 50
        for s, k in pattern:
            used[s] = used.get(s, 0) + k * n
    assert used == counts


def _optimum(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity and bins[j] not in bins[:j]:
                place(i + 1, bins[:j] + [bins[j] + items[i]] + bins[j + 1 :])
        place(i + 1, bins + [items[i]])

    place(0, [])
    return best


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_dominance_loses_nothing(items):
    counts = {s: items.count(s) for s in set(items)}
    fixed, left = packing.dominance(counts, 20)
    rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
    assert sum(n for _, n in fixed) + (_optimum(rest, 20) if rest else 0) == _optimum(sorted(items, reverse=True), 20)


# ------------------------------------------------------------------ 9


def test_mix_reaches_the_targets(spark):
    rng = random.Random(6)
    rows = [(i, "word " * rng.randint(1, 400), s) for i, s in enumerate(rng.choices(["a", "b", "c"], [8, 3, 1], k=1500))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)], "source string, target_share double, max_repeats int")
    for r in mixing.mix_report(docs, targets).collect():
        assert abs(r["actual_share"] - r["target_share"]) < 0.002 and r["most_copies"] <= r["max_repeats"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 500), st.integers(1, 60)), min_size=1, max_size=30, unique_by=lambda c: c[:2]), st.floats(-0.004, 0.004))
def test_rounding_keeps_the_tokens_of_a_source(cells, lam):
    mix = {"a": (0.5, 3), "b": (0.5, 1)}
    got = mixing.round_cells(cells, {"a": (lam, 0.0), "b": (-abs(lam), 0.0)}, mix)
    for s in "ab":
        mine = [c for c in got if c[0] == s]
        if mine:
            wanted, given_ = sum(t * n * w for _, t, n, w, _, _ in mine), sum(t * (n * low + extra) for _, t, n, _, low, extra in mine)
            assert abs(wanted - given_) <= max(t for _, t, *_ in mine) / 2 + 1e-6
            assert all(0 <= extra <= n and low + (extra > 0) <= mix[s][1] for _, _, n, _, low, extra in mine)


def test_ranks_over_many_ranges(spark):
    rng = random.Random(9)
    rows = [(rng.choice("aab"), rng.choice([None, rng.random(), 0.5]), rng.randint(1, 4)) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, q double, w int").repartition(7)
    got = capping.before_in_groups(df, "g", [F.asc_nulls_last("q")], "w", "before").collect()
    for g in "ab":
        x = sorted((r for r in got if r["g"] == g), key=lambda r: r["before"])
        assert all(r["before"] == sum(y["w"] for y in x[:i]) for i, r in enumerate(x))
        assert [r["q"] for r in x] == sorted((r["q"] for r in x), key=lambda q: (q is None, q or 0))


@pytest.mark.parametrize("limit", [100, 7])
def test_pieces_stay_below_the_limit(limit):
    rng = np.random.default_rng(4)
    order = rng.permutation(3000)
    a, b = order[:-1], order[1:]  # one chain through nodes in random order
    shuffled = rng.permutation(len(a))
    forest = Forest(limit)
    out = [p for i in range(0, len(a), 250) for p in forest.add(a[shuffled[i : i + 250]].astype(np.int64), b[shuffled[i : i + 250]].astype(np.int64))] + list(forest.rest())
    assert forest.largest <= limit and set(np.concatenate([n for n, _ in out])) == set(range(3000))
    nodes, roots = spanning_forest(np.concatenate([n for n, _ in out]), np.concatenate([r for _, r in out]))
    assert len(set(roots.tolist())) == 1


def test_a_long_chain_is_one_group(spark):
    order = list(range(2500))
    random.Random(1).shuffle(order)
    rows = [(f"{i:05d}", f"k{p}", f"k{p + 1}") for i, p in enumerate(order)] + [("z1", "other", None), ("z2", "other", None)]
    df = spark.createDataFrame(rows, "id string, a string, b string").repartition(6)
    # both ends of a link stand in one column of keys
    links = df.select("id", F.explode(F.array("a", "b")).alias("k")).filter("k is not null")
    got = {r["id"]: r["group_id"] for r in components.link_groups(links, "id", [F.col("k")], edges_per_partition=100).collect()}
    assert {got[f"{i:05d}"] for i in range(2500)} == {"00000"} and got["z2"] == "z1"


# ------------------------------------------------------------------ 10

CLEAN = {
    "fr": ["Où que soit stockée la clé, la méthode doit l’effacer dès la fermeture.", "Le contrôleur d’accès refuse désormais les origines inconnues.", "Ça échoue parfois, la réponse est tronquée à la première requête."],
    "de": ["Die Prüfung schlägt fehl, sobald die Schlüssel gelöscht werden.", "Größere Einträge über hundert müssen künftig bestätigt werden.", "Außerdem gehört die Änderung zum Übertragungskanal."],
    "ru": ["Теперь журнал событий отклоняет повторные сообщения.", "Ошибка возникает, когда экран получает много записей подряд.", "Мы добавили проверку длины и ограничили число попыток."],
    "pl": ["Błąd pojawia się po wielu próbach połączenia z urządzeniem.", "Użytkownik może cofnąć zgodę, zanim moduł wyśle żądanie.", "Moduł wciąż działał, gdy dziennik zdarzeń był już zamknięty."],
    "ja": ["利用者は署名の前に確認を求められます。", "修正により、鍵はメモリからすぐに消去されます。", "ロック解除の後、通信経路は古い残高を表示していた。"],
}


@pytest.fixture(scope="module")
def restorer():
    return mojibake.Restorer({lang: mojibake._dictionary(lines * 3) for lang, lines in CLEAN.items()})


@pytest.mark.parametrize("lang, read, written", [("fr", "cp1252", "utf-8"), ("de", "cp437", "utf-8"), ("de", "mac_roman", "utf-8"), ("ru", "cp1251", "utf-8"), ("ru", "cp866", "utf-8"), ("ru", "cp1252", "cp1251"), ("ru", "cp1251", "koi8-r"), ("pl", "cp1250", "utf-8"), ("pl", "latin-1", "iso8859-2"), ("ja", "latin-1", "euc_jp"), ("ja", "latin-1", "utf-8")])
def test_round_trip(restorer, lang, read, written):
    for line in CLEAN[lang]:
        back = {b: c for c, b in mojibake._TABLES[read].items()}
        garbled = "".join(chr(back.get(b, b)) for b in line.encode(written, "ignore"))
        fixed, chain, bad = restorer.text("plain first line\n" + garbled)
        assert bad and chain and fixed.split("\n")[1] == line.encode(written, "ignore").decode(written)


@pytest.mark.parametrize("lang, read, written", [("de", "cp1252", "mac_roman"), ("pl", "cp1252", "cp1250"), ("fr", "cp1252", "cp850")])
def test_garbling_into_letters_and_common_signs(restorer, lang, read, written):
    """Pairs whose garbled forms are letters or ordinary punctuation are tried like all others."""
    back = {b: c for c, b in mojibake._TABLES[read].items()}
    line = CLEAN[lang][1].replace("’", "'") if lang == "fr" else CLEAN[lang][1]
    garbled = "".join(chr(back.get(b, b)) for b in line.encode(written))
    fixed, chain, bad = restorer.text(garbled)
    assert bad and chain and fixed == line


def test_known_words_are_clean_ones():
    texts = [(lang, "\n".join(lines)) for lang, lines in CLEAN.items() for _ in range(4)] + [("pl", CLEAN["pl"][0].encode("cp1250").decode("cp1252"))] * 2
    dictionaries, known = mojibake._dictionaries(texts)
    garbled = {w for w in texts[-1][1].split(" ") if not w.isascii()} - set(CLEAN["pl"][0].split(" "))
    assert known and not known & garbled and "Błąd" in known
    r = mojibake.Restorer(dictionaries, known)
    assert r.text(texts[-1][1])[0] == CLEAN["pl"][0]
    whole = mojibake.Restorer(dictionaries)
    for w in known:
        assert not whole.judge((w,))[1]


def test_models_count_all_documents(spark):
    """Words of few of many documents and of long texts are counted, however the table is split."""
    rare = [f"Über{a}{b}" for a in ("wurf", "trag", "lauf", "gang", "blick") for b in ("prüfung", "größe", "schlüssel", "änderung")]
    rows = [(i, CLEAN["de"][i % 3], "de") for i in range(900)] + [(1000 + i, f"Die {w} gehört dazu.", "de") for i, w in enumerate(rare * 2)]
    rows += [(2000 + i, "Le contrôleur d’accès refuse. " * 200, "fr") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    dictionaries, known = mojibake.train(df.repartition(5))
    assert set(rare) <= known and all(w.encode() in dictionaries["de"] for w in rare) and "contrôleur" in known
    assert (dictionaries, known) == mojibake.train(df.repartition(1)) == mojibake._dictionaries([(r[2], r[1]) for r in rows])


def _judged_by_all(r, words):
    """The verdict with every candidate compressed under every dictionary, and the number of compressions."""
    calls = 0

    def size(words):
        nonlocal calls
        text = " ".join(words)
        calls += len(r.by_language)
        more = mojibake.LOST_COST * (text.count("�") + len(mojibake._CONTROL.findall(text))) + mojibake.FOREIGN_COST * len(mojibake._FOREIGN.findall(text))
        return min(len(c.compress(mojibake.packed(f" {text} "))) for c in r.by_language.values()) + more

    best, name, cost = words, "", size(words)
    level, seen = [(words, "", cost, 0)], {words}
    for _ in range(mojibake.MAX_STEPS):
        others, usual = [], []
        for at, chain, before, spent in level:
            for cand, label, price in mojibake.steps(at):
                if cand not in seen:
                    seen.add(cand)
                    total, label = size(cand) + spent + price, f"{chain}, {label}" if chain else label
                    if total < cost:
                        best, name, cost = cand, label, total
                    (usual if price == mojibake.STEP_COST and total < before else others).append((cand, label, total, spent + price))
        level = usual + [x for x in others if x[2] <= cost + mojibake.STEP_COST]
    return (best, name), calls


class _Counting:
    calls = 0

    def __init__(self, compressor):
        self.compressor = compressor

    def compress(self, b):
        _Counting.calls += 1
        return self.compressor.compress(b)


def test_few_candidates_are_compressed_and_none_is_missed():
    """What a bound rules out isn't compressed, and the verdicts are those of compressing all."""
    r = mojibake.Restorer(*mojibake._dictionaries([(lang, "\n".join(lines)) for lang, lines in CLEAN.items() for _ in range(4)]))
    _Counting.calls, of_all = 0, 0
    r.compressors = [_Counting(c) for c in r.by_language.values()]
    for lines in CLEAN.values():
        for line in lines[:2]:
            for read, written in (("cp1252", "utf-8"), ("cp437", "utf-8"), ("cp1251", "koi8-r"), ("latin-1", "cp1250"), ("cp1252", None)):
                back = {b: c for c, b in mojibake._TABLES[read].items()}
                text = line if written is None else "".join(chr(back.get(b, b)) for b in line.encode(written, "ignore"))
                if read == "cp1252" and written:
                    text += " " + "".join(chr(back.get(b, b)) for b in text.encode())
                words = tuple(w for w in text.split(" ") if not w.isascii())
                if words:
                    verdict, n = _judged_by_all(r, words)
                    of_all += n
                    assert r.judge(words) == verdict
    assert 0 < _Counting.calls < of_all / 3


def test_bounds_hold():
    r = mojibake.Restorer(*mojibake._dictionaries([(lang, "\n".join(lines)) for lang, lines in CLEAN.items() for _ in range(4)]))
    rng = random.Random(4)
    signs = "aeinrst" * 3 + "éüßñłąЖдо名前の�\x85Ã©Â€"
    texts = [f" {' '.join(''.join(rng.choices(signs, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 60)))} " for _ in range(300)]
    texts += [f" {x} " for lines in CLEAN.values() for x in lines] + [f" {x * 40} " for x in ("é", "éa", "дом ".strip())]
    texts += [f" {''.join(rng.choices(signs, k=50_000))} ", "  ", "   é "]
    b = [mojibake.packed(x) for x in texts]
    together = r.bounds.of(b)
    for x, bounds in zip(b, together.tolist()):
        sizes = [len(c.compress(x)) for c in r.compressors]
        assert all(n <= s for n, s in zip(bounds, sizes)), (x, bounds, sizes)
    assert together[:300].all() and not together[-3:].any()


def test_twice_garbled_and_clean(restorer):
    line = CLEAN["fr"][0]
    once = line.encode().decode("cp1252", "replace")
    if "�" not in once:
        twice = once.encode("cp1252").decode("latin-1").encode("utf-8").decode("latin-1")
        assert restorer.text(twice)[2]
    for lines in CLEAN.values():
        for x in lines:
            assert restorer.text(x) == (x, "", False)
    for x in ("ATENÇÃO: NÃO use isto", "├── src\n│   └── a.ts", "€ £ ¥ ¬ ¦ – © 2031", "Â, Ã and Ä are upper-case letters", "Ångström, Čapek-Gasse, Łąka, Ğ", "Größe: 12 kΩ ± 5 %, √2 ≈ 1,41"):
        assert restorer.text(x)[2] is False
    assert restorer.text("s�o")[2] is True

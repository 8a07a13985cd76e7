"""Golden inputs of the gate's rules."""

import re

import pytest
from pyspark.sql import functions as F

from fixcorpus.functions import patterns as P
from fixcorpus.functions import text as T
from fixcorpus.operators import features, redact


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("title", ["redesign the transaction list UI", "add unit tests for the tx decoder", "update README", "bump lodash to 4.17.21", "refactor button styles", "redesign the assign flow", "seeded random for tests"])
def test_benign_titles_score_nothing(spark, title):
    assert one(spark, features.vocabulary_score(features.vocabulary_hits(F.col("t"))), t=title) == 0.0


@pytest.mark.parametrize(
    "title, group",
    [
        ("clear seed from memory after unlock", "key_material"),
        ("EIP-712 domain separator missing chainId allows signature replay", "signing"),
        ("shamir share reconstruction accepts duplicate indices", "mpc"),
        ("user verification flag not checked in WebAuthn assertion", "platform"),
        ("dapp could bypass origin check via postMessage", "transport"),
        ("nonce reuse", "signing"),
        ("nonce-reuse", "signing"),
        ("nonce_reuse", "signing"),
    ],
)
def test_groups(spark, title, group):
    assert one(spark, features.vocabulary_hits(F.col("t"))[group], t=title)


@pytest.mark.parametrize("title, drops", [
    ("Bump @metamask/eth-simple-keyring from 6.0.0 to 6.0.1 (#288)", True), ("deps: @metamask/eth-hd-keyring@^6.0.0->^7.0.1 (#275)", True), ("chore: bump `@metamask/keyring-api` to ^3.0.0 (#344)", True),
    ("chore: update eth-simple-keyring (#171)", True), ("deps: bump @scure/bip39 to 1.2.0", True), ("Validate seed across all wordlists (#77)", False), ("do not allow re-initialization of keyring instance (#55)", False),
    ("chore: update validation logic", False), ("fix: update keyring unlock to clear the seed", False),
])
def test_version_bumps(spark, title, drops):
    assert one(spark, P.hits(F.col("t"), P.DEP_BUMP), t=title) is drops


@pytest.mark.parametrize("title, drops", [
    ("build: supply `-Wl,--high-entropy-va`", True), ("ci: pin github actions", True), ("test: add seed derivation cases", True), ("refactor: rename keyring fields", True),
    ("build: make the release reproducible", False), ("build: verify firmware signature before flashing", False), ("ci: add sbom generation", False), ("fix: clear seed from memory", False), ("ecdsa: adhere strictly to RFC6979", False),
])
def test_meta_prefix(spark, title, drops):
    t = F.col("t")
    assert one(spark, P.hits(t, P.META_PREFIX) & ~P.hits(t, P.SUPPLY_CHAIN), t=title) is drops


def test_keyword_tries_equal_plain_alternations():
    from fixcorpus.functions import vocabulary as V

    texts = ["private key leak", "seeds", "seed", "k reuse", "low-s", "CVE-2020", "xcve-1", "secure_element", "threshold  bypass", "approve_x", "pre-approve", "DoS", "dos attack", "oob", "k-reuse"]
    for keywords in V.GROUPS.values():
        for form in (P.literal, P.loose):
            trie = re.compile(P.alternation(keywords, form), re.I)
            plain = [re.compile((r"\b" if k[:1].isalnum() else "") + form(k) + (r"\b" if k[-1:].isalnum() else ""), re.I) for k in keywords]
            for t in texts + keywords:
                assert bool(trie.search(t)) == any(p.search(t) for p in plain), (t, keywords[0])


@pytest.mark.parametrize("kind, value", [
    ("AWS-KEY-ID", "AK" + "IA" + "ABCDEFGHIJKLMNOP"), ("GITHUB-TOKEN", "gh" + "p_" + "a1" * 15), ("SLACK-TOKEN", "xo" + "xb-1234567890-abc"), ("XPRV", "xp" + "rv" + "A1b2" * 20),
    ("HEX-PRIVKEY", "private key " + "0f" * 32), ("MNEMONIC", "mnemonic: " + " ".join(["apple", "river", "stone"] * 4)),
])
def test_redaction(spark, kind, value):
    df = spark.createDataFrame([(f"leaked {value} here", None)], "title string, description string")
    r = redact.redact_columns(df).first()
    assert kind in r["title_kinds"] and redact.MASK in r["title"] and r["description"] is None
    again = redact.redact_columns(spark.createDataFrame([(r["title"], None)], "title string, description string")).first()
    assert again["title"] == r["title"]


@pytest.mark.parametrize("value", ["bump lodash to 4.17.21", "fix_commit " + "ab" * 20, "integrity sha512-" + "Ab1+" * 10, "derive xpub6CUGRUo from the account node"])
def test_redaction_keeps(spark, value):
    df = spark.createDataFrame([(value, "")], "title string, description string")
    assert redact.redact_columns(df).first()["title"] == value


def test_identifiers(spark):
    assert one(spark, T.contest_slug(F.col("c")), c="  Foo/Bar Baz! ") == "foo-bar-baz"
    assert one(spark, T.merge_severity(F.col("c")), c="high") == "Info"
    assert one(spark, T.merge_severity(F.col("c")), c="critical") == "High"
    assert one(spark, T.first_semver(F.col("c")), c=">=1.2.3, <2") == "1.2.3"
    assert one(spark, T.issue_kind(F.col("c")), c="PR#12") == "PR"
    assert one(spark, T.title_key(F.col("c")), c="  Fix: (A)-b!  ") == "fix ab"
    assert one(spark, T.title_key(F.col("c")), c="!!!") is None

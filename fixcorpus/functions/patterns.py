"""Patterns built at plan time.

All patterns run as Java regular expressions inside generated code. FLAGS makes
them case-insensitive with Unicode classes and Unix line ends. Word boundaries
are factored out of alternations, which Java evaluates several times faster.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V

FLAGS = "(?iUd)"


def literal(keyword: str) -> str:
    """A keyword as it is written; characters with a meaning in patterns are escaped."""
    return re.sub(r"([.^$*+?{}\[\]\\|()/-])", r"\\\1", keyword)


def loose(keyword: str) -> str:
    """A keyword whose words may be joined by any run of space, hyphen or underscore."""
    return r"[-_\s]+".join(literal(p) for p in keyword.split())


def _atoms(keyword: str, form) -> list[str]:
    """A keyword as pattern atoms, one per character; what joins words loosely is one atom."""
    if form is loose:
        out: list[str] = []
        for i, part in enumerate(keyword.split()):
            out += ([r"[-_\s]+"] if i else []) + [literal(c.lower()) for c in part]
        return out
    return [literal(c.lower()) for c in keyword]


def _trie(keywords: list[str], form) -> str:
    """An alternation in which common beginnings are written once, so that a text is held against few branches."""
    root: dict = {}
    for k in keywords:
        node = root
        for atom in _atoms(k, form):
            node = node.setdefault(atom, {})
        node[""] = {}

    def write(node: dict) -> str:
        ends = "" in node
        branches = []
        for atom, sub in node.items():
            if atom:
                branches.append(atom + write(sub))
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and not ends else f"(?:{'|'.join(branches)})"
        return body + "?" if ends else body

    return write(root)


def alternation(keywords: list[str], form=literal, extra: str = "") -> str:
    """One pattern for all keywords with \\b at alphanumeric edges; boundaries and beginnings are factored out."""
    whole = [k for k in keywords if k[:1].isalnum() and k[-1:].isalnum()]
    rest = [(r"\b" if k[:1].isalnum() else "") + form(k) + (r"\b" if k[-1:].isalnum() else "") for k in keywords if not (k[:1].isalnum() and k[-1:].isalnum())]
    parts = ([_trie(whole, form)] if whole else []) + ([extra] if extra else [])
    return "|".join(([rf"\b(?:{'|'.join(parts)})\b"] if parts else []) + rest)


STRONG = alternation([k for g in V.STRONG_GROUPS for k in V.GROUPS[g]], extra=V.STRONG_WORDS)
MODERATE = alternation([k for g in V.MODERATE_GROUPS for k in V.GROUPS[g]], extra=V.MODERATE_WORDS)

# fixed values: what the stages of the gate look for
BOILERPLATE = r"critical update required|urgency guidelines|high-urgency|update is (?:strongly )?recommended for all|this is a (?:low|medium|high)-urgency release"
CVE = r"CVE-\d{4}-\d{4,7}|GHSA-[0-9a-z]{4}-[0-9a-z]{4}-[0-9a-z]{4}"
ADVISORY_ID = CVE + r"|RUSTSEC-\d{4}-\d{4}"
NOISE_TITLE = r"(?:^|\b)(?:bump |chore\(deps|dependabot|renovate|pin github actions|github actions|codeql|add .*security scan|security scanning|security policy|security\.md|code of conduct|\breadme\b|update copyright|update license|documentation update|update docs|docs:|changelog|typo in|fix typo|add default security|create security policy)"
DEP_BUMP = (
    r"^\s*(?:chore|deps?|build|ci|fix|feat)?\s*(?:\([^)]*\))?\s*:?\s*(?:bump|upgrade|update)\b[^\n]{0,80}?(?:\bfrom\s+v?\d|\bto\s+v?\d|@[\^~]?\d|\bv?\d+\.\d+)"
    r"|^\s*(?:deps|dependencies|dependabot|renovate)\b\s*[:\[]"
    r"|@[\w.@/-]+@[\^~]?\d[\w.-]*\s*(?:->|→|to)\s*[\^~]?\d"
    r"|^\s*bump\b[^\n]{0,60}\bversion\b"
    r"|^\s*(?:chore|deps?|build|ci)\s*(?:\([^)]*\))?\s*:\s*(?:update|upgrade|bump)\s+`?[@\w][\w.@/-]*[-/@][\w.@/-]*`?\s*(?:\(#\d+\))?\s*$"
)
META_PREFIX = r"^\s*(?:build|ci|test|tests|docs?|style|perf|refactor|chore)\s*(?:\([^)]*\))?\s*!?:"
SUPPLY_CHAIN = (
    r"reproducib\w*|deterministic build|code[- ]?signing|notariz\w*|secure[- ]?boot|supply[- ]?chain|typosquat|postinstall|attestation|sbom|provenance"
    r"|(?:verif\w*|validat\w*|check\w*)[^.\n]{0,30}(?:signature|checksum|hash|firmware|binary|artifact|release|download)"
    r"|(?:signature|checksum|firmware|binary|artifact)[^.\n]{0,30}(?:verif\w*|validat\w*)|update channel|rollback attack|downgrade attack"
)
BARE_CVE_TITLE = r"^\s*CVE-\d{4}-\d{3,7}\s*$"
FIX_IMPACT = (
    r"\b(?:fix|fixes|fixed|prevent|avoid|guard|handle|resolve|correct|patch)\w*\b[^.\n]{0,40}\b(?:crash|panic|segfault|deadlock|hang|freeze|oom|out.of.memory|overflow|underflow|data race|race condition|reorg"
    r"|non.?determin|infinite loop|use.after.free|null (?:pointer|deref)|key leak|seed leak|signature replay|replay|nonce reuse|origin check|approval|allowance|phishing|spoof|bypass|leak)\b"
    r"|\b(?:crash|panic|segfault|deadlock|hang|oom|overflow|underflow|reorg|race condition)\b[^.\n]{0,25}\b(?:fix|fixed|prevent|avoid|guard against|resolved|patch)\w*\b"
)
DEP_ADVISORY = (
    r"(?:github|dependabot|snyk|npm audit|yarn audit|renovate)\s+(?:security\s+)?(?:warning|alert|advisor|vulnerabilit)"
    r"|vulnerabilit(?:y|ies)\s+(?:found\s+)?(?:by|from|in|reported by)\s+(?:github|dependabot|snyk|npm)"
    r"|(?:fix|resolve|address)\w*\s+vulnerabilit(?:y|ies)\s+by\s+github"
    r"|\b(?:security\s+)?(?:warning|alert)s?\s+for\s+(?:javascript|ruby|python|go|rust|node)?\s*(?:packages|gems|modules|deps)\b"
    r"|\b(?:bump|upgrade|update)\b[^\n]{0,80}?\b(?:gem|npm package|dependencies|dependency|to\s+(?:a\s+)?(?:non-)?vulnerable)\b"
    r"|\b(?:bump|upgrade|update)\s+[`'\"]?[\w@][\w@./-]*[`'\"]?\s+(?:due to|because of|for|to fix|to address|to resolve)\s+(?:(?:the|a|an|critical|high|known|reported|multiple)\s+){0,3}(?:CVE-|GHSA-|RUSTSEC-|vulnerabilit|security)"
    r"|\bvulnerable version of\b"
)
SECURITY_LINE = r"\b(security|vuln(erability)?|CVE-\d{4}-\d+|DoS|panic|crash|RCE|memory[ _-]?leak|integer[ _-]?overflow|race[ _-]?condition)\b"
SEVERITY_WORD = r"\b(Critical|High|Medium|Low)\b"
URGENCY = r"\b(urgency.{0,30}guidelines|critical update required|high-urgency|low-urgency|medium-urgency|urgency-level)\b"
NON_PRODUCT_FILE = r"(?:^|/)\.github/|(?:^|/)\.circleci/|(?:^|/)docs?/|\.md$|\.txt$|(?:^|/)tests?/|(?:^|/)__tests__/|[._-]test\.[a-z]+$|[._-]spec\.[a-z]+$|(?:^|/)fixtures?/|\.ya?ml$|\.lock$|(?:^|/)Makefile$|Dockerfile"
DEPENDENCY_TITLE = r"upgrade|update|bump|dependab|netty|log4j|spring|jackson|guava|protobuf|golang\.org/x|rustsec|jsonparser|libp2p|discv5|openssl|zlib|\bcrate\b"


def hits(text: Column, pattern: str, flags: str = FLAGS) -> Column:
    """Whether a pattern is found anywhere; null text is no hit."""
    return F.coalesce(text.rlike(flags + pattern), F.lit(False))


def keyword_list(text: Column, keywords: list[str], form=loose) -> Column:
    """The keywords found, in their given order; the list is only looked at where any is found."""
    each = F.array_compact(F.array(*[F.when(hits(text, alternation([k], form)), F.lit(k)) for k in keywords]))
    return F.when(hits(text, alternation(keywords, form)), each).otherwise(F.array().cast("array<string>"))

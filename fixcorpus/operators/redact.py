"""Masking of credential shapes in titles and descriptions, before anything is scored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = "XXXXXXX"
# fixed values: credential shapes in the order in which they are masked
SHAPES: list[tuple[str, str]] = [
    ("AWS-KEY-ID", r"\b(?:AKIA|ASIA|AGPA|AIDA|AROA|AIPA|ANPA|ANVA)[0-9A-Z]{16}\b"),
    ("GITHUB-TOKEN", r"\b(?:ghp|gho|ghu|ghs|ghr|github_pat)_[A-Za-z0-9_]{20,}\b"),
    ("SLACK-TOKEN", r"\bxox[baprs]-[A-Za-z0-9-]{10,}\b"),
    ("STRIPE-KEY", r"\b(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}\b"),
    ("SENDGRID-KEY", r"\bSG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}\b"),
    ("GOOGLE-API-KEY", r"\bAIza[0-9A-Za-z_-]{35}\b"),
    ("OPENAI-KEY", r"\bsk-[A-Za-z0-9]{20,}\b"),
    ("PRIVATE-KEY-PEM", r"(?s)-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----.*?-----END (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    ("JWT", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\b"),
    ("XPRV", r"\b(?:xprv|yprv|zprv|tprv|uprv|vprv)[1-9A-HJ-NP-Za-km-z]{70,120}\b"),
    ("WIF-KEY", r"\b[5KL][1-9A-HJ-NP-Za-km-z]{50,51}\b"),
    ("HEX-PRIVKEY", r"(?i)(?:priv(?:ate)?[_ -]?key|secret[_ -]?key|seed|entropy|mnemonic)[^\n]{0,40}?\b(?:0x)?[0-9a-f]{64}\b"),
    ("SECRET", r"(?i)(?:aws|secret|access[_ -]?key|api[_ -]?key|token|password|credential)[^\n]{0,40}?(?<![A-Za-z0-9/+=])[A-Za-z0-9/+=]{40}(?![A-Za-z0-9/+=])"),
]
PHRASE_CONTEXT = r"(?i)mnemonic|seed[_ -]?phrase|recovery[_ -]?phrase|seed[_ -]?words"
WORD_RUN = r"\b(?:[a-z]{3,8}\s+){11,23}[a-z]{3,8}\b"
#: What a text must hold for any shape to be in it; looked for once before the shapes are.
MAY_HOLD = r"\b(?:AKIA|ASIA|AGPA|AIDA|AROA|AIPA|ANPA|ANVA)[0-9A-Z]|gh[pousr]_|github_pat_|xox[baprs]-|[sr]k_(?:live|test)_|SG\.|AIza|\bsk-|-----BEGIN|eyJ|(?<![A-Za-z0-9/+=])[A-Za-z0-9/+=]{40}"
KINDS = [k for k, _ in SHAPES] + ["MNEMONIC"]


def redact(c: Column, may: Column) -> tuple[Column, Column]:
    """(masked text, kinds found): every shape is looked for in what the ones before it left, where ``may`` says so."""
    out, kinds = c, []
    for kind, shape in SHAPES:
        kinds.append(F.when(may & F.coalesce(out.rlike(shape), F.lit(False)), F.lit(kind)))
        out = F.regexp_replace(out, shape, MASK)
    out = F.when(may, out).otherwise(c)
    phrase = F.coalesce(out.rlike(PHRASE_CONTEXT) & out.rlike(WORD_RUN), F.lit(False))
    kinds.append(F.when(phrase, F.lit("MNEMONIC")))
    return F.when(phrase, F.regexp_replace(out, WORD_RUN, MASK)).otherwise(out), F.array_compact(F.array(*kinds))


def redact_columns(df: DataFrame, columns: tuple[str, ...] = ("title", "description")) -> DataFrame:
    """The columns masked, and ``<column>_kinds`` beside each. Nulls stay null; masking twice changes nothing."""
    df = df.withColumns({f"_may_{c}": F.coalesce(F.col(c).rlike(MAY_HOLD), F.lit(False)) for c in columns})
    for c in columns:
        masked, kinds = redact(F.col(c), F.col(f"_may_{c}"))
        df = df.withColumns({f"{c}_kinds": kinds, c: masked})
    return df.drop(*[f"_may_{c}" for c in columns])


def _once(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose expressions are computed once per row, not again wherever a later stage uses the column.

    A one-element array is exploded: unlike a projection, that is not merged
    into the stages above.
    """
    rest = [c for c in df.columns if c not in new]
    x = df.select(*rest, F.explode(F.array(F.struct(*[c.alias(n) for n, c in new.items()]))).alias("_once"))
    return x.select(*[F.col("_once")[c].alias(c) if c in new else F.col(c) for c in df.columns])


def masked(df: DataFrame, columns: tuple[str, ...] = ("title", "description")) -> DataFrame:
    """The columns masked as by ``redact_columns``, without the kinds."""
    shaped = {}
    for c in columns:
        out = F.col(c)
        for _, shape in SHAPES:
            out = F.regexp_replace(out, shape, MASK)
        shaped[c] = F.when(F.coalesce(F.col(c).rlike(MAY_HOLD), F.lit(False)), out).otherwise(F.col(c))
    phrase = {c: F.when(F.coalesce(F.col(c).rlike(PHRASE_CONTEXT) & F.col(c).rlike(WORD_RUN), F.lit(False)), F.regexp_replace(c, WORD_RUN, MASK)).otherwise(F.col(c)) for c in columns}
    return _once(_once(df, shaped), phrase)


def tally(df: DataFrame, columns: tuple[str, ...] = ("title", "description")) -> DataFrame:
    """(column_name, kind, n_rows): a row counts once per kind and column."""
    x = redact_columns(df.select(*columns), columns)
    per = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_kinds").alias("kinds")) for c in columns])).alias("x")
    long = x.select(per).select("x.column_name", F.explode("x.kinds").alias("kind"))
    return long.groupBy("column_name", "kind").agg(F.count("*").alias("n_rows"))


def rows_touched(df: DataFrame, columns: tuple[str, ...] = ("title", "description")) -> DataFrame:
    """One row: how many rows of each column hold any credential."""
    x = redact_columns(df.select(*columns), columns)
    return x.agg(*[F.count_if(F.size(f"{c}_kinds") > 0).alias(f"{c}_rows") for c in columns])

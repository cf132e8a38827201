"""Column functions over text: tokens, cleaning, hyphen forms, wildcard terms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexigrid.functions.udfs import unicode_normalize

# A token is a run of letters and digits, or one other non-blank character.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"

# Sentences close after the last of a run of stops; a line break always closes one.
# One class after the stop, not a repeated group: that would recurse for every stop.
SENTENCE_PATTERN = r"[^.!?\n]*[.!?][.!? \t\x0B\f\r]*|[^.!?\n]+"

# Must equal the reference's.
SINGLE_QUOTES = "‘’‛‹›"
DOUBLE_QUOTES = "ʺ˝ˮ˵˶̋«»“”‟"
TERM_SPECIALS = '"$()+[]^{}\\'
TOKEN_PUNCTUATION = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'

# Every blank character of Unicode, the four ASCII separator controls among them.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
BLANK = r"(?U)[\s\x1c-\x1f]"
NON_ASCII = r"[^\x00-\x7F]"


def tokenize(text: Column | str) -> Column:
    """Array of tokens, case kept."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def tokenize_lower(text: Column | str) -> Column:
    """Array of lower-cased tokens, aligned with :func:`tokenize`.

    Lower-casing the whole text first is cheaper. Only U+0130 lower-cases to two
    code points, so texts holding it lower each token to keep positions aligned.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(
        F.contains(text, F.lit("\u0130")), F.transform(tokenize(text), F.lower)
    ).otherwise(tokenize(F.lower(text)))


def count_tokens(text: Column | str) -> Column:
    """Number of tokens, without building the array."""
    return F.regexp_count(text, F.lit(TOKEN_PATTERN))


def split_sentences(text: Column | str) -> Column:
    """Array of non-blank sentences."""
    return F.filter(
        F.regexp_extract_all(text, F.lit(SENTENCE_PATTERN), F.lit(0)),
        lambda s: s.rlike(r"\S"),
    )


def split_paragraphs(text: Column | str) -> Column:
    """Array of non-blank lines."""
    return F.filter(F.split(text, "\n", -1), lambda p: p.rlike(r"\S"))


def is_word(token: Column) -> Column:
    """Whether a token counts as a word: it starts with a letter or digit."""
    return token.rlike(r"^[\p{L}\p{N}]")


def clean_text(text: Column | str, form: str | None = "NFKC") -> Column:
    """Strip, turn each blank into one space, unify quotes, normalize Unicode.

    Blanks are replaced one for one, never collapsed; one pass maps all characters.
    Normalization needs Python, so only texts with a non-ASCII character go through it.
    """
    to = " " * len(BLANKS) + "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES)
    out = F.trim(F.translate(text, BLANKS + SINGLE_QUOTES + DOUBLE_QUOTES, to))
    if form is None:
        return out
    normalized = unicode_normalize(form)(F.when(out.rlike(NON_ASCII), out))
    return F.coalesce(normalized, out)


def hyphen_forms(term: Column | str, atomic: bool = True) -> Column:
    """The spellings a hyphenated term may take, as an array of strings.

    ``a--b``: joined, apart, hyphenated, and (if ``atomic``) with the hyphen as a
    token of its own. ``a-b``: as it is, and atomic. Anything else: as it is.
    """
    term = F.col(term) if isinstance(term, str) else term
    own_token = F.replace(
        F.replace(term, F.lit("-"), F.lit(" - ")), F.lit("-  -"), F.lit("-")
    )
    double = [
        F.replace(term, F.lit("-"), F.lit("")),
        F.replace(F.replace(term, F.lit("-"), F.lit(" ")), F.lit("  "), F.lit(" ")),
        F.replace(term, F.lit("--"), F.lit("-")),
    ]
    single = [term]
    if atomic:
        double.append(own_token)
        single.append(own_token)
    forms = (
        F.when(F.contains(term, F.lit("--")), F.array(*double))
        .when(F.contains(term, F.lit("-")), F.array(*single))
        .otherwise(F.array(term))
    )
    return F.filter(forms, lambda f: f != "")


def escape_term(term: Column | str) -> Column:
    r"""Backslash the characters that would act as regex syntax."""
    return F.regexp_replace(term, "([" + "".join("\\" + c for c in TERM_SPECIALS) + "])", r"\\$1")


def has_wildcard(term: Column | str) -> Column:
    """Whether a term holds ``*``, ``?`` or ``.`` and so is a pattern."""
    term = F.col(term) if isinstance(term, str) else term
    return term.rlike(r"[*?.]")


def term_regex(term: Column | str) -> Column:
    """Anchored regex of a (not yet escaped) term: ``*`` any run, ``?`` and ``.`` one."""
    body = F.replace(F.replace(escape_term(term), F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return F.concat(F.lit("^(?:"), body, F.lit(")$"))


def term_predicate(attr: Column, term: str) -> Column:
    """Predicate for one literal term: equality where possible, else anchored regex."""
    if not any(c in term for c in "*?."):
        return attr == F.lit(term)
    escaped = "".join("\\" + c if c in TERM_SPECIALS else c for c in term)
    return attr.rlike("^(?:" + escaped.replace("*", ".*").replace("?", ".") + ")$")


def rule_kind(rule: Column | str) -> Column:
    """``ID`` for a list of token numbers, otherwise ``CQL``."""
    packed = F.replace(rule, F.lit(" "), F.lit(""))
    return F.when(packed.rlike(r"^[\[\]#\p{Nd}|]+$"), F.lit("ID")).otherwise(F.lit("CQL"))


def strip_bom(body: Column | str) -> Column:
    """Drop leading byte-order marks."""
    return F.regexp_replace(body, "^\ufeff+", "")

"""Column-level text functions (all native Spark expressions, no UDFs).

Ids in docstrings refer to the operator inventory (P*, F*).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions import patterns as pt


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def computed_once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often ``use`` reads it.

    A column read twice in one expression is computed twice wherever the
    optimizer does not see both readings as certain (branches of CASE, fields
    of a struct); a variable bound by ``transform`` holds its value.
    """
    return F.transform(F.array(value), use)[0]


def replace_where(col, literals: list[str], pattern: str, replacement: str) -> Column:
    """``regexp_replace`` for a pattern whose every match holds one of the literals: texts without them are passed on."""
    def step(t: Column) -> Column:
        holds = t.contains(literals[0])
        for one in literals[1:]:
            holds = holds | t.contains(one)
        return F.when(holds, F.regexp_replace(t, pattern, replacement)).otherwise(t)
    return computed_once(_c(col), step)


def py_strip(col) -> Column:
    """Python ``str.strip()``: drop leading/trailing Python whitespace."""
    return F.regexp_extract(_c(col), pt.STRIPPED, 1)


def split_whitespace(col) -> Column:
    """Python ``str.split()`` with no argument (P11 pieces)."""
    return F.array_remove(F.split(F.regexp_replace(_c(col), pt.OTHER_WS, " "), " ", -1), "")


def collapse_whitespace(col) -> Column:
    """P11 ``' '.join(t.split())``."""
    return F.array_join(split_whitespace(col), " ")


def first_words(col, n: int = 300) -> Column:
    """P12 first ``n`` whitespace words, joined by one space."""
    return F.array_join(F.slice(split_whitespace(col), 1, n), " ")


def newline_to_space(col) -> Column:
    """P13 ``t.replace('\\n', ' ')``."""
    return F.translate(_c(col), "\n", " ")


def splitlines(col) -> Column:
    """Python ``str.splitlines()``: no trailing empty line, '' -> []."""
    parts = F.split(_c(col), pt.LINE_BREAK, -1)
    return F.when(F.element_at(parts, -1) == "",
                  F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def file_lines(col) -> Column:
    """Lines of a text file read with universal newlines."""
    parts = F.split(_c(col), pt.UNIVERSAL_NEWLINE, -1)
    return F.when(F.element_at(parts, -1) == "",
                  F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


# --------------------------------------------------------------------------
# P6 / F5  Gopher quality heuristics
# --------------------------------------------------------------------------

def words(col) -> Column:
    """P6 regex word tokenizer ``[\\w'-]+``."""
    return F.regexp_extract_all(_c(col), F.lit(pt.WORD_PATTERN), 0)


def gopher_metrics(col) -> Column:
    """F5 metrics as a struct of exact integer counts plus pass flag/reason.

    Fields: n_words, n_word_chars, n_lines, n_ellipsis_lines, n_alpha_words,
    passed, reason.  One regex pass leaves the words, a blank between them;
    their number, their chars and the words without a letter are counted on
    that.  A line whose stripped form ends in '...' is one match of
    ELLIPSIS_LINE_END.
    """
    t = _c(col)
    found = computed_once(F.regexp_replace(t, pt.NO_WORD_RUN, " "), lambda w: computed_once(
        F.struct(w.alias("w"), F.length(w).alias("n"), F.length(F.replace(w, F.lit(" "), F.lit(""))).alias("chars")), _word_counts))
    n_breaks = (F.regexp_count(t, F.lit(pt.LINE_END_CHAR))
                - F.when(t.contains("\r\n"), F.regexp_count(t, F.lit("\r\n"))).otherwise(0))
    ends_open = (F.length(t) > 0) & ~F.substring(t, -1, 1).rlike(pt.LINE_END)
    n_ell = F.when(t.contains("..."), F.regexp_count(t, F.lit(pt.ELLIPSIS_LINE_END))).when(t.isNotNull(), 0)
    counts = F.struct(
        found.alias("words"),
        (n_breaks + F.when(ends_open, 1).otherwise(0)).cast("bigint").alias("n_lines"),
        n_ell.cast("bigint").alias("n_ellipsis_lines"),
    )
    return computed_once(counts, _gopher_verdict)


def _word_counts(m: Column) -> Column:
    """n_words, n_word_chars, n_alpha_words of words with a blank between them (and perhaps around them)."""
    w = m["w"]
    n_words = F.when(m["n"] == 0, 0).otherwise(m["n"] - m["chars"] + 1 - w.startswith(" ").cast("int") - w.endswith(" ").cast("int"))
    return computed_once(n_words.cast("bigint"), lambda n: F.struct(
        n.alias("n_words"), m["chars"].cast("bigint").alias("n_word_chars"),
        (n - F.regexp_count(w, F.lit(pt.WORD_NO_LETTER))).alias("n_alpha_words")))


def _gopher_verdict(m: Column) -> Column:
    """The counts with the flag and the first failing rule."""
    words = m["words"]
    n_words, n_lines = words["n_words"], m["n_lines"]
    mean_len = F.try_divide(words["n_word_chars"].cast("double"), F.greatest(n_words, F.lit(1)))
    ell_frac = F.try_divide(m["n_ellipsis_lines"].cast("double"), n_lines)
    alpha_frac = F.try_divide(words["n_alpha_words"].cast("double"), F.greatest(n_words, F.lit(1)))
    reason = (F.when((n_words < pt.GOPHER_MIN_WORDS) | (n_words > pt.GOPHER_MAX_WORDS), "word_count")
              .when((mean_len < pt.GOPHER_MIN_MEAN_LEN) | (mean_len > pt.GOPHER_MAX_MEAN_LEN), "mean_word_length")
              .when((n_lines > 0) & (ell_frac > pt.GOPHER_MAX_ELLIPSIS_FRAC), "ellipsis_lines")
              .when(alpha_frac < pt.GOPHER_MIN_ALPHA_FRAC, "alphabetic_words"))
    return F.struct(
        n_words.alias("n_words"), words["n_word_chars"].alias("n_word_chars"), n_lines.alias("n_lines"),
        m["n_ellipsis_lines"].alias("n_ellipsis_lines"), words["n_alpha_words"].alias("n_alpha_words"),
        reason.isNull().alias("passed"), reason.alias("reason"))


def gopher_passes(col) -> Column:
    """F5 ``run_gopher_quality_filter`` as a boolean Column."""
    return gopher_metrics(col)["passed"]


# --------------------------------------------------------------------------
# P7-P10  PII masking
# --------------------------------------------------------------------------

def mask(col, pattern: str, token: str) -> Column:
    """Generic ``re.subn``: struct(text, n); a text without a match is passed on after the count."""
    def counted(t: Column) -> Column:
        return F.struct(t.alias("t"), F.regexp_count(t, F.lit(pattern)).cast("bigint").alias("n"))

    def replaced(m: Column) -> Column:
        new = F.regexp_replace(m["t"], pattern, token.replace("$", "\\$"))
        return F.struct(F.when(m["n"] > 0, new).otherwise(m["t"]).alias("text"), m["n"].alias("n"))
    return computed_once(computed_once(_c(col), counted), replaced)


def mask_email(col, pattern: str = pt.EMAIL_HEADS) -> Column:
    """P7."""
    return mask(col, pattern, pt.EMAIL_TOKEN)


def mask_phone(col, pattern: str = pt.PHONE_PATTERN) -> Column:
    """P8."""
    return mask(col, pattern, pt.PHONE_TOKEN)


def mask_ip(col, pattern: str = pt.IP_PATTERN) -> Column:
    """P9."""
    return mask(col, pattern, pt.IP_TOKEN)


# --------------------------------------------------------------------------
# P4 P5 F2-F4  Wikipedia cleaning and filters
# --------------------------------------------------------------------------

def clean_wikitext(col) -> Column:
    """The ordered markup substitutions, then strip."""
    t = replace_where(col, ["</ref>"], r"(?s)<ref[^>]*>.*?</ref>", "")
    t = replace_where(t, ["<ref"], r"<ref[^/]*?/>", "")
    t = replace_where(t, ["{{"], r"\{\{[^}]+\}\}", "")
    t = replace_where(t, ["[[Category:"], r"\[\[Category:[^\]]+\]\]", "")
    t = replace_where(t, ["[["], r"\[\[[^|\]]+\|([^\]]+)\]\]", "$1")
    t = replace_where(t, ["[["], r"\[\[([^\]]+)\]\]", "$1")
    t = replace_where(t, ["[http"], r"\[https?://[^\]]+\]", "")
    t = replace_where(t, ["<"], r"<[^>]+>", "")
    t = replace_where(t, ["''"], r"'{2,}", "")
    t = replace_where(t, ["=="], r"={2,}([^=]+)={2,}", "$1")
    t = replace_where(t, ["\n\n\n"], r"\n{3,}", "\n\n")
    t = replace_where(t, ["  "], r"  +", " ")
    return py_strip(t)


def clean_article(col) -> Column:
    """P5: cut at the earliest tail marker, drop leftovers, strip."""
    ws = pt.UNI_WS
    markers = "|".join(pt.TAIL_MARKERS)
    t = replace_where(col, pt.TAIL_MARKERS, f"(?s)({markers}).*", "")
    t = replace_where(t, ["."], rf"(?md)^[A-Z][a-z]+\.[{ws}]*$", "")
    t = replace_where(t, [")"], rf"(?md)^\p{{Nd}}+\)[{ws}]*", "")
    t = replace_where(t, ["("], r"\([^)]*[\x{4e00}-\x{9fff}][^)]*\)", "")
    t = replace_where(t, ["("], r"\([^)]*[\x{0400}-\x{04FF}][^)]*\)", "")
    t = replace_where(t, ["("], r"(?iu)\(pinyin:[^)]+\)", "")
    t = replace_where(t, ["\n\n\n"], r"\n{3,}", "\n\n")
    t = replace_where(t, ["  "], r"  +", " ")
    return py_strip(t)


def article_metrics(col) -> Column:
    """F2 inputs as exact counts: words, lines, bullet lines, ASCII chars."""
    def counts(t: Column) -> Column:
        lines = computed_once(F.split(py_strip(t), "\n", -1), lambda ls: F.struct(
            F.size(ls).cast("bigint").alias("n"),
            F.size(F.filter(ls, lambda l: l.rlike(pt.BULLET_LINE))).cast("bigint").alias("bullets")))
        return F.struct(
            F.size(split_whitespace(t)).cast("bigint").alias("n_words"),
            lines.alias("lines"),
            F.length(F.regexp_replace(t, r"[^\x00-\x7F]+", "")).cast("bigint").alias("n_ascii"),
            F.length(t).cast("bigint").alias("n_chars"))

    return computed_once(computed_once(_c(col), counts), lambda m: F.struct(
        m["n_words"].alias("n_words"), m["lines"]["n"].alias("n_lines"), m["lines"]["bullets"].alias("n_bullet_lines"),
        m["n_ascii"].alias("n_ascii"), m["n_chars"].alias("n_chars")))


def filter_article(col) -> Column:
    """F2 ``filter_article``: >=50 words, <=50% bullets, >=80% ASCII."""
    return computed_once(article_metrics(col), lambda m: (
        (m["n_words"] >= pt.ARTICLE_MIN_WORDS)
        & ~(F.try_divide(m["n_bullet_lines"].cast("double"), F.greatest(m["n_lines"], F.lit(1)))
            > pt.ARTICLE_MAX_BULLET_FRAC)
        & ~(F.try_divide(m["n_ascii"].cast("double"), F.greatest(m["n_chars"], F.lit(1)))
            < pt.ARTICLE_MIN_ASCII_FRAC)))


def is_namespace_title(col) -> Column:
    """namespace pages carry ':' anywhere in the title."""
    return _c(col).contains(":")


def min_length(col, n: int = pt.ARTICLE_MIN_LENGTH) -> Column:
    """length in code points >= n."""
    return F.length(_c(col)) >= n


# --------------------------------------------------------------------------
# F8 F9 P11-P13 P19 misc predicates / projections
# --------------------------------------------------------------------------

def non_blank(col) -> Column:
    """F8."""
    return F.length(py_strip(col)) > 0


def valid_url(col) -> Column:
    """F9 starts with http, no space, shorter than 500 code points."""
    u = _c(col)
    return u.startswith("http") & ~u.contains(" ") & (F.length(u) < 500)


def snippet(col, key, seed: int = 0, size: int = 500) -> Column:
    """P19 deterministic ``size``-char window; null when text is shorter."""
    t = _c(col)
    span = F.length(t) - (size - 1)
    offset = F.pmod(F.xxhash64(F.lit(seed), _c(key)), span.cast("bigint"))
    return F.when(F.length(t) >= size, F.substring(t, (offset + 1).cast("int"), size))


# --------------------------------------------------------------------------
# P15-P17 generated-text post-processing and chat template
# --------------------------------------------------------------------------

def clean_generated(col) -> Column:
    """P15 ``clean_text``."""
    t = _c(col)
    for tok in pt.SPECIAL_TOKENS:
        t = F.replace(t, F.lit(tok), F.lit(""))
    t = F.translate(t, "’‘", "''")
    w = pt.REGEX_WORD_CLASS
    t = F.regexp_replace(t, rf"({w}) ' ({w})", "$1'$2")
    t = F.regexp_replace(t, rf"({w}) '({w})", "$1'$2")
    t = F.regexp_replace(t, rf"({w})' ({w})", "$1'$2")
    t = F.regexp_replace(t, rf"[{pt.UNI_WS}]+([.,!?;:])", "$1")
    t = F.regexp_replace(t, rf"[{pt.UNI_WS}]+", " ")
    t = py_strip(t)
    # Capitalise the first character and the first lower-case ASCII letter
    # after [.!?] + blank: cut before each such letter, upper-case each
    # piece's head.  Every step reads the previous one once, so the
    # expression tree does not duplicate the substitution chain.
    pieces = F.split(t, "(?<=[.!?] )(?=[a-z])", -1)
    t = F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                                            F.substring(p, 2, 1 << 30))), "")
    # end with '.' unless empty or already ending in . ! ?
    return F.regexp_replace(t, r"([^.!?])\z", "$1.")


def extract_response(col) -> Column:
    """P16 text after the last assistant tag, markers dropped, P15."""
    t = F.substring_index(_c(col), pt.ASSISTANT_TAG, -1)
    for tok in pt.SPECIAL_TOKENS:
        t = F.replace(t, F.lit(tok), F.lit(""))
    return clean_generated(t)


def chat_prompt(col, chat_mode: bool = True) -> Column:
    """P17 prompt template."""
    if not chat_mode:
        return _c(col)
    return F.concat(F.lit(pt.USER_TAG + "\n"), _c(col), F.lit("\n" + pt.ASSISTANT_TAG + "\n"))

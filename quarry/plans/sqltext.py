"""Helpers to write the DuckDB oracle SQL with the same regex classes."""

from __future__ import annotations

from quarry.functions import patterns as pt


def lit(s: str) -> str:
    """SQL string literal (standard SQL: backslashes are literal)."""
    return "'" + s.replace("'", "''") + "'"


def py_strip(expr: str) -> str:
    ws = pt.PY_WS
    return f"regexp_replace({expr}, {lit(f'^[{ws}]+|[{ws}]+$')}, '', 'g')"


def split_ws(expr: str) -> str:
    return f"regexp_extract_all({expr}, {lit(pt.NONSPACE_RUN)})"


def splitlines(expr: str) -> str:
    parts = f"string_split_regex({expr}, {lit(pt.LINE_BREAK)})"
    return (f"(CASE WHEN {parts}[-1] = '' THEN {parts}[1:len({parts})-1] "
            f"ELSE {parts} END)")


def file_lines(expr: str) -> str:
    parts = f"string_split_regex({expr}, {lit(pt.UNIVERSAL_NEWLINE)})"
    return (f"(CASE WHEN {parts}[-1] = '' THEN {parts}[1:len({parts})-1] "
            f"ELSE {parts} END)")


def words(expr: str) -> str:
    return f"regexp_extract_all({expr}, {lit(pt.WORD_PATTERN)})"


def gopher_cte(src: str = "documents", text: str = "text", key: str = "doc_id") -> str:
    """CTE body producing the F5 count columns + reason for ``src``."""
    return f"""
    SELECT {key}, n_words, n_word_chars, n_lines, n_ellipsis_lines, n_alpha_words,
      CASE
        WHEN n_words < {pt.GOPHER_MIN_WORDS} OR n_words > {pt.GOPHER_MAX_WORDS} THEN 'word_count'
        WHEN n_word_chars / greatest(n_words, 1) < {pt.GOPHER_MIN_MEAN_LEN}
          OR n_word_chars / greatest(n_words, 1) > {pt.GOPHER_MAX_MEAN_LEN} THEN 'mean_word_length'
        WHEN n_lines > 0 AND n_ellipsis_lines / n_lines > {pt.GOPHER_MAX_ELLIPSIS_FRAC} THEN 'ellipsis_lines'
        WHEN n_alpha_words / greatest(n_words, 1) < {pt.GOPHER_MIN_ALPHA_FRAC} THEN 'alphabetic_words'
      END AS reason
    FROM (
      SELECT {key},
        len(w)::BIGINT AS n_words,
        length(array_to_string(w, ''))::BIGINT AS n_word_chars,
        len(lines)::BIGINT AS n_lines,
        len(list_filter(lines, lambda l: regexp_matches(l, {lit(pt.ELLIPSIS_LINE)})))::BIGINT AS n_ellipsis_lines,
        len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}')))::BIGINT AS n_alpha_words
      FROM (SELECT {key}, {words(text)} AS w, {splitlines(text)} AS lines FROM {src})
    )"""


def mask_chain(text: str = "text") -> tuple[str, str, str, str]:
    """(masked_text, n_email, n_phone, n_ip) expressions for P10."""
    e_pat, p_pat, i_pat = lit(pt.EMAIL_PATTERN), lit(pt.PHONE_PATTERN), lit(pt.IP_PATTERN)
    t1 = f"regexp_replace({text}, {e_pat}, {lit(pt.EMAIL_TOKEN)}, 'g')"
    t2 = f"regexp_replace({t1}, {p_pat}, {lit(pt.PHONE_TOKEN)}, 'g')"
    t3 = f"regexp_replace({t2}, {i_pat}, {lit(pt.IP_TOKEN)}, 'g')"
    return (t3,
            f"len(regexp_extract_all({text}, {e_pat}))::BIGINT",
            f"len(regexp_extract_all({t1}, {p_pat}))::BIGINT",
            f"len(regexp_extract_all({t2}, {i_pat}))::BIGINT")


# NFD of the accented letters present in the shared tables, after lower():
# (letter, base, combining mark code point).  Oracle-side only; Spark runs a
# real Unicode NFD.
NFD_PAIRS = [("ä", "a", 776), ("ç", "c", 807), ("è", "e", 768), ("é", "e", 769),
             ("ê", "e", 770), ("í", "i", 769), ("ñ", "n", 771), ("ó", "o", 769),
             ("ö", "o", 776), ("ü", "u", 776)]


def normalize(expr: str) -> str:
    t = f"lower({expr})"
    for ch, base, mark in NFD_PAIRS:
        t = f"replace({t}, '{ch}', '{base}' || chr({mark}))"
    t = f"regexp_replace({t}, '\\p{{P}}+', '', 'g')"
    t = f"regexp_replace({t}, {lit('[' + pt.UNI_WS + ']+')}, ' ', 'g')"
    return py_strip(t)


def minhash_removed_sql(num_hashes: int, num_bands: int, n: int, t: float) -> str:
    """Reference MinHash-LSH semantics written naively (all bucket pairs)."""
    r = num_hashes // num_bands
    return f"""
    WITH w AS (SELECT doc_id, {split_ws(normalize('text'))} AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) >= {n}
            THEN list_distinct(list_transform(range(1, len(w) - {n} + 2),
                 lambda i: array_to_string(w[i:i + {n - 1}], ' ')))
            ELSE []::VARCHAR[] END AS sh FROM w),
    sig AS (SELECT doc_id, list_transform(range(0, {num_hashes}),
              lambda h: coalesce(list_min(list_transform(sh, lambda g: md5(h::VARCHAR || g))), 'inf')) AS sig
            FROM s),
    b AS (SELECT doc_id, bi, array_to_string(sig[bi * {r} + 1 : bi * {r} + {r}], ',') AS bk
          FROM sig, range(0, {num_bands}) rr(bi)),
    pairs AS (SELECT DISTINCT x.doc_id AS i, y.doc_id AS j FROM b x JOIN b y
              ON x.bi = y.bi AND x.bk = y.bk AND x.doc_id < y.doc_id),
    ver AS (SELECT DISTINCT p.j FROM pairs p JOIN s a ON a.doc_id = p.i JOIN s c ON c.doc_id = p.j
            WHERE (CASE WHEN len(a.sh) = 0 AND len(c.sh) = 0 THEN 1.0
                        WHEN len(a.sh) = 0 OR len(c.sh) = 0 THEN 0.0
                        ELSE len(list_intersect(a.sh, c.sh)) / len(list_distinct(a.sh || c.sh)) END) >= {t})
    SELECT j AS doc_id FROM ver"""


def utf8_bytes(expr: str) -> str:
    return (f"list_transform(regexp_extract_all(hex(encode({expr})), '..'), "
            f"lambda x: ('0x' || x)::INTEGER)")


def pretoken_words(expr: str) -> str:
    """GPT-2 pre-tokens without look-ahead (marker before the last blank)."""
    ws = pt.UNI_WS
    pat = ("'(?:[sdmt]|ll|ve|re)| ?\\p{L}+| ?\\p{N}+| ?[^" + ws + "\\p{L}\\p{N}]+|[" + ws + "]+")
    marked = (f"regexp_replace({expr}, {lit('([' + ws + '])([' + ws + '][^' + ws + '])')}, "
              f"'\\1' || chr(1) || '\\2', 'g')")
    return (f"flatten(list_transform(string_split({marked}, chr(1)), "
            f"lambda piece: regexp_extract_all(piece, {lit(pat)})))")


SPECIALS_SPLIT = r"<\|endoftext\|>|<\|assistant\|>|<\|user\|>"


def chain(expr: str, steps) -> str:
    """Apply (pattern, replacement) regexp_replace steps (Java $1 -> RE2 \\1)."""
    t = expr
    for pat, rep in steps:
        pat = pat.replace("(?md)", "(?m)").replace("(?iu)", "(?i)").replace("(?is)", "(?is)")
        rep = rep.replace("$1", "\\1").replace("$2", "\\2")
        t = f"regexp_replace({t}, {lit(pat)}, {lit(rep)}, 'g')"
    return t


WIKITEXT_STEPS = [
    (r"(?s)<ref[^>]*>.*?</ref>", ""), (r"<ref[^/]*?/>", ""), (r"\{\{[^}]+\}\}", ""),
    (r"\[\[Category:[^\]]+\]\]", ""), (r"\[\[[^|\]]+\|([^\]]+)\]\]", "$1"),
    (r"\[\[([^\]]+)\]\]", "$1"), (r"\[https?://[^\]]+\]", ""), (r"<[^>]+>", ""),
    (r"'{2,}", ""), (r"={2,}([^=]+)={2,}", "$1"), ("\\n{3,}", "\n\n"), (r" +", " "),
]


def clean_wikitext(expr: str) -> str:
    return py_strip(chain(expr, WIKITEXT_STEPS))


def clean_article(expr: str) -> str:
    ws = pt.PY_WS
    markers = "|".join(pt.TAIL_MARKERS)
    steps = [(f"(?s)({markers}).*", ""),
             (rf"(?m)^[A-Z][a-z]+\.[{ws}]*$", ""),
             (rf"(?m)^\p{{Nd}}+\)[{ws}]*", ""),
             (r"\([^)]*[\x{4e00}-\x{9fff}][^)]*\)", ""),
             (r"\([^)]*[\x{0400}-\x{04FF}][^)]*\)", ""),
             (r"(?i)\(pinyin:[^)]+\)", ""),
             ("\\n{3,}", "\n\n"), (r"  +", " ")]
    return py_strip(chain(expr, steps))


def article_ok(expr: str) -> str:
    lines = f"string_split({py_strip(expr)}, chr(10))"
    n_words = f"len({split_ws(expr)})"
    n_bullet = f"len(list_filter({lines}, lambda l: regexp_matches(l, {lit(pt.BULLET_LINE)})))"
    n_ascii = f"length(regexp_replace({expr}, '[^\\x00-\\x7F]', '', 'g'))"
    return (f"({n_words} >= {pt.ARTICLE_MIN_WORDS} AND NOT ({n_bullet} / greatest(len({lines}), 1) > "
            f"{pt.ARTICLE_MAX_BULLET_FRAC}) AND NOT ({n_ascii} / greatest(length({expr}), 1) < "
            f"{pt.ARTICLE_MIN_ASCII_FRAC}))")


# Restated for the oracle: what the pages of the shared tables can hold.
_BLOCKS = ("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
           "header hr li main nav ol p pre section table td th title tr ul").split()
_NAMED = [("copy", 169), ("middot", 183), ("quot", 34), ("lt", 60), ("gt", 62), ("nbsp", 160), ("eacute", 233), ("uuml", 252)]


def html_text(expr: str) -> str:
    t = expr
    for pat in ("(?s)<!--.*?-->", r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>",
                r"(?is)<head\b[^>]*>.*?</head\s*>"):
        t = f"regexp_replace({t}, {lit(pat)}, '', 'g')"
    t = f"regexp_replace({t}, {lit('(?i)</?(?:' + '|'.join(_BLOCKS) + ')' + chr(92) + 'b[^>]*>')}, chr(10), 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', '', 'g')"
    for name, code in _NAMED:
        t = f"replace({t}, '&{name};', chr({code}))"
    t = f"replace({t}, '&amp;', '&')"
    lines = (f"list_filter(list_transform(string_split({t}, chr(10)), "
             f"lambda l: trim(regexp_replace(l, {lit('[ ' + chr(92) + 't' + chr(92) + 'x{A0}]+')}, ' ', 'g'), ' ')), lambda l: l <> '')")
    return f"array_to_string({lines}, chr(10))"


def clean_generated(expr: str) -> str:
    t = expr
    for tok in pt.SPECIAL_TOKENS:
        t = f"replace({t}, {lit(tok)}, '')"
    t = f"replace(replace({t}, chr(8217), ''''), chr(8216), '''')"
    w = pt.REGEX_WORD_CLASS
    uw = pt.UNI_WS
    t = chain(t, [(f"({w}) ' ({w})", "$1'$2"), (f"({w}) '({w})", "$1'$2"), (f"({w})' ({w})", "$1'$2"),
                  (f"[{uw}]+([.,!?;:])", "$1"), (f"[{uw}]+", " ")])
    t = py_strip(t)
    t = f"(upper(substr({t}, 1, 1)) || substr({t}, 2))"
    marked = f"regexp_replace({t}, {lit('([.!?][' + uw + ']+)([a-z])')}, '\\1' || chr(0) || '\\2', 'g')"
    pieces = f"string_split({marked}, chr(0))"
    t = (f"array_to_string(list_transform({pieces}, lambda p, i: CASE WHEN i = 1 THEN p "
         f"ELSE upper(substr(p, 1, 1)) || substr(p, 2) END), '')")
    return (f"(CASE WHEN length({t}) > 0 AND right({t}, 1) NOT IN ('.', '!', '?') "
            f"THEN {t} || '.' ELSE {t} END)")


# Symbols of a word under training: one character per id, far from combining marks.
_SYM = 20_000


def _symbols(expr: str) -> str:
    return f"array_to_string(list_transform({utf8_bytes(expr)}, lambda x: chr(x + {_SYM})), '')"


def bpe_training(words_sql: str, n_merges: int) -> str:
    """CTEs of one-at-a-time BPE training: b0.. (the pair of each merge) and vocab (id, bytes as hex).

    Every merge counts all pairs anew and rewrites every word: slow and plain,
    independent of how the engine follows the counts.
    """
    from quarry.operators.tokenizer import base_vocab
    first = len(base_vocab(pt.SPECIAL_TOKENS))
    extra = ", ".join(f"({i}, '{b.hex().upper()}')" for i, b in base_vocab(pt.SPECIAL_TOKENS).items() if i > 255)
    ctes = [f"w0 AS MATERIALIZED (SELECT cnt, {_symbols('word')} AS s FROM ({words_sql}))",
            f"v0 AS MATERIALIZED (SELECT i AS id, printf('%02X', i) AS hex FROM range(256) r(i) "
            f"UNION ALL SELECT * FROM (VALUES {extra}) x(id, hex))"]
    for i in range(n_merges):
        new = first + i
        ctes += [
            f"b{i} AS MATERIALIZED (SELECT p FROM (SELECT cnt, substr(s, unnest(range(1, length(s))), 2) AS p "
            f"FROM w{i} WHERE length(s) >= 2) GROUP BY p ORDER BY sum(cnt) DESC, p LIMIT 1)",
            f"m{i} AS MATERIALIZED (SELECT {i} AS rank, l.id::INTEGER AS left_id, r.id::INTEGER AS right_id, {new} AS new_id, "
            f"l.hex AS l, r.hex AS r FROM b{i} JOIN v{i} l ON l.id = unicode(p[1]) - {_SYM} JOIN v{i} r ON r.id = unicode(p[2]) - {_SYM})",
            f"v{i + 1} AS MATERIALIZED (SELECT * FROM v{i} UNION ALL SELECT new_id, l || r FROM m{i})",
            f"w{i + 1} AS MATERIALIZED (SELECT cnt, replace(s, (SELECT p FROM b{i}), chr({new + _SYM})) AS s "
            f"FROM w{i} WHERE length(s) >= 2)"]
    return ",\n".join(ctes)


def bpe_encoded(word: str, n_merges: int, first_id: int = 259) -> str:
    """Ids of a word under the merges b0..: all merges in rank order (a whole-vocabulary word is settled by the caller)."""
    s = _symbols(word)
    for i in range(n_merges):
        s = f"replace({s}, (SELECT p FROM b{i}), chr({first_id + i + _SYM}))"
    return f"list_transform(string_split({s}, ''), lambda x: (unicode(x) - {_SYM})::INTEGER)"

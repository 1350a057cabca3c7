"""Regular expressions and literal tables shared by the text operators.

Spark evaluates regexes with java.util.regex; the SQL oracle uses RE2.  Python's
``\\s``/``\\d``/``str.split`` semantics are therefore written out as explicit
character classes so both engines agree with the reference behaviour.
"""

# ---------------------------------------------------------------------------
# These must equal the reference behaviour for right results.
# ---------------------------------------------------------------------------

# PII patterns and replacement tokens (email, phone, IP), in masking order.
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
EMAIL_TOKEN = "|||EMAIL_ADDRESS|||"
PHONE_TOKEN = "|||PHONE_NUMBER|||"
IP_TOKEN = "|||IP_ADDRESS|||"

# GPT-2 pre-tokenizer pattern and the special tokens of the tokenize job.
SPECIAL_TOKENS = ["<|endoftext|>", "<|user|>", "<|assistant|>"]
ENDOFTEXT = "<|endoftext|>"
USER_TAG = "<|user|>"
ASSISTANT_TAG = "<|assistant|>"

# Wikipedia article tail markers, in the order they are tried.
TAIL_MARKERS = ["Related pages", "References", "Other websites", "Notes", "Sources"]

# Gopher quality thresholds.
GOPHER_MIN_WORDS = 50
GOPHER_MAX_WORDS = 100_000
GOPHER_MIN_MEAN_LEN = 3
GOPHER_MAX_MEAN_LEN = 10
GOPHER_MAX_ELLIPSIS_FRAC = 0.3
GOPHER_MIN_ALPHA_FRAC = 0.8

# Wikipedia article filter thresholds.
ARTICLE_MIN_WORDS = 50
ARTICLE_MAX_BULLET_FRAC = 0.5
ARTICLE_MIN_ASCII_FRAC = 0.8
ARTICLE_MIN_LENGTH = 200

# ---------------------------------------------------------------------------
# Character classes (bodies, without brackets) derived from Unicode tables.
# ---------------------------------------------------------------------------

# Python ``str.isspace`` / ``re`` ``\s`` / ``str.split()`` / ``str.strip()``.
PY_WS = (r"\t\n\x0B\x0C\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Unicode White_Space (the ``regex`` module's ``\s``): PY_WS without 1C-1F.
UNI_WS = (r"\t\n\x0B\x0C\r\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
          r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# ``str.splitlines()`` line boundaries.
LINE_BREAK = r"\r\n|[\n\x0B\x0C\r\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"
# Universal-newline reading of a text file (``open(..., 'r')``).
UNIVERSAL_NEWLINE = r"\r\n|\r|\n"

# ---------------------------------------------------------------------------
# Engine forms of the fixed patterns (same in java.util.regex and RE2).
# ---------------------------------------------------------------------------

PHONE_PATTERN = (r"\(?\p{Nd}{3}\)?[" + PY_WS + r".\-]?\p{Nd}{3}["
                 + PY_WS + r".\-]?\p{Nd}{4}")
IP_PATTERN = r"\b(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}\b"

WORD_PATTERN = r"[\p{L}\p{N}_'-]+"          # regex fallback word tokenizer
NONSPACE_RUN = "[^" + PY_WS + "]+"            # str.split() pieces
ELLIPSIS_LINE = r"\.\.\.[" + PY_WS + "]*$"    # line.strip().endswith('...')
BULLET_LINE = "^[" + PY_WS + r"]*[*\-#]"      # line.strip().startswith(*-#)

# GPT-2 pattern for Java (look-ahead kept; \s made Unicode White_Space).
GPT2_PAT = ("'(?:[sdmt]|ll|ve|re)| ?\\p{L}+| ?\\p{N}+| ?[^" + UNI_WS
            + "\\p{L}\\p{N}]+|[" + UNI_WS + "]+(?![^" + UNI_WS + "])|["
            + UNI_WS + "]+")

# The ``regex`` module's ``\w`` (Alphabetic, marks, decimal digits, connector
# punctuation, joiners).
REGEX_WORD_CLASS = r"[\p{L}\p{Nl}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}]"

# Counting forms used by the Gopher metrics (one regex pass each, no arrays).
WORD_CHARS_NEG = r"[^\p{L}\p{N}_'-]"                      # chars outside every word
LETTER_WORD = r"[\p{N}_'-]*\p{L}[\p{L}\p{N}_'-]*"          # a word holding a letter
LINE_END = r"(?:\r\n|[\n\x0B\x0C\r\x1C\x1D\x1E\x{85}\x{2028}\x{2029}])"
# Python whitespace that is not a splitlines() boundary.
INLINE_WS = r"\t\x20\x1F\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
ELLIPSIS_LINE_END = r"\.\.\.[" + INLINE_WS + r"]*(?:" + LINE_END + r"|\z)"

# Forms for java.util.regex alone.  Nested classes are tried from the left, so
# printable ASCII is settled by one comparison.
OTHER_WS = "[[^ -~]&&[" + PY_WS + "]]"                    # whitespace other than the blank
STRIPPED = r"(?s)\A[" + PY_WS + "]*(.*[^" + PY_WS + "])?"   # group 1: what str.strip() leaves
NO_WORD_RUN = r"[^a-zA-Z[\p{L}\p{N}_'-]]+"                # runs of WORD_CHARS_NEG
WORD_NO_LETTER = r"(?<![^ ])[\p{N}_'-]++(?![^ ])"          # where blanks part the words
LINE_END_CHAR = r"[[^ -~]&&[\n\x0B\x0C\r\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]]"  # \r\n counts twice
# EMAIL_PATTERN: when it fails from the head of a run of name characters, it fails
# from every later one of them, so only heads are tried (or where the last match ended).
EMAIL_HEADS = r"(?:\G|(?<![a-zA-Z0-9._%+-]))[a-zA-Z0-9._%+-]++@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"

"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsieve.functions.arrays import is_any_of
from clipsieve.functions.rules import RULES, TERM, URL, WHITESPACE_CHARS, WHITESPACE_CLASS, TextRules
from clipsieve.functions.unicode import nfc
from clipsieve.settings import NoiseLists

_SPACE_RUN = rf"[{WHITESPACE_CLASS}]+"
DOCUMENTED = RULES["documented"]


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def normalize_token(token: Column) -> Column:
    """Lower-case, turn ``#`` and ``_`` into spaces, collapse and trim whitespace."""
    spaced = F.translate(F.lower(token), "#_", "  ")
    return F.btrim(F.regexp_replace(spaced, _SPACE_RUN, " "), F.lit(" "))


def normalize_tag(tag: Column) -> Column:
    return normalize_token(F.btrim(tag, F.lit("# ")))


def is_noise(token: Column, noise: NoiseLists) -> Column:
    return is_any_of(F.lower(token), noise.all_words)


def drop_noise(tokens: Column, noise: NoiseLists) -> Column:
    return F.filter(tokens, lambda token: ~is_noise(token, noise))


def drop_normal_noise(tokens: Column, noise: NoiseLists) -> Column:
    """``drop_noise`` for tokens that are in lower case already."""
    return F.filter(tokens, lambda token: ~is_any_of(token, noise.all_words))


def without_links(desc: Column, rules: TextRules = DOCUMENTED) -> Column:
    """Lower case, with URLs and handles blanked out."""
    return F.regexp_replace(F.regexp_replace(F.lower(desc), URL, " "), rules.handle, " ")


def _tokens(source: Column, may_hold_underscore: Column, rules: TextRules) -> Column:
    # A token holds neither spaces nor '#', so only an underscore makes normalising change it.
    tokens = F.regexp_extract_all(source, F.lit(rules.token), F.lit(0))
    normal = F.transform(
        tokens, lambda token: F.when(token.contains("_"), normalize_token(token)).otherwise(token)
    )
    return F.when(may_hold_underscore, F.filter(normal, lambda token: token != "")).otherwise(tokens)


def lexicon_tokens(plain: Column, rules: TextRules = DOCUMENTED) -> Column:
    """Tokens of a text ``without_links``, inline hashtags included, noise not yet removed."""
    return _tokens(plain, plain.contains("_"), rules)


def topic_tokens(plain: Column, rules: TextRules = DOCUMENTED) -> Column:
    """As ``lexicon_tokens`` but without inline hashtags."""
    return _tokens(F.regexp_replace(plain, rules.inline_tag, " "), plain.contains("_"), rules)


def tag_words(normal_tags: Column) -> Column:
    """The single words of all normalised tags."""
    words = F.flatten(F.transform(normal_tags, lambda tag: F.split(tag, " ")))
    return F.filter(words, lambda word: word != "")


def entity_text(desc: Column, raw_tags: Column, rules: TextRules = DOCUMENTED) -> Column:
    """Case-preserving text with marked handles and URLs and one ``[HASHTAG: …]`` per tag."""
    marked = F.regexp_replace(nfc(desc), URL, "<URL>")
    marked = F.regexp_replace(marked, rules.handle, r"<HANDLE>@$1</HANDLE>")
    kept = F.filter(raw_tags, lambda tag: tag != "")
    tags = F.transform(kept, lambda tag: F.concat(F.lit("[HASHTAG: "), tag, F.lit("]")))
    return strip(F.concat(marked, F.lit(" "), F.array_join(tags, " ")))


def terms(text: Column) -> Column:
    """Lower-case word runs of two or more characters, the unit of TF-IDF."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))

"""Column functions over document text. All of them stay in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gramledger.config import HASH_CHARSET, PHRASE_LENGTH, SEPARATORS


def normalized(content: Column) -> Column:
    """Lower-cased text with every run of separators replaced by one space.

    A leading space stands for the empty first token that text starting with a
    separator has; a trailing one carries no meaning.
    """
    return F.regexp_replace(F.lower(content), SEPARATORS, " ")


def tokens(content: Column) -> Column:
    """Tokens of the text: a leading empty token is kept, trailing ones are not."""
    parts = F.split(F.lower(content), SEPARATORS)
    open_end = (F.size(parts) > 1) & (F.element_at(parts, -1) == "")
    trimmed = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    only_separators = (F.size(parts) == 2) & (F.element_at(parts, 1) == "")
    return (
        F.when(~open_end, parts)
        .when(only_separators, F.slice(parts, 1, 0))
        .otherwise(trimmed)
    )


def content_hash(content: Column) -> Column:
    """Document identity: case, punctuation and word boundaries do not count."""
    return F.sha1(F.encode(F.regexp_replace(F.lower(content), SEPARATORS, ""), HASH_CHARSET))


def pieces(text: Column, length: int, tokens: int) -> Column:
    """Stretches of `tokens` tokens of a normalized text, each with the length - 1 tokens after it.

    One pass: a look-ahead takes the longer stretch, the match itself the shorter.
    A space that begins a text stays, for the empty token it stands for.
    """
    own, longer = (f"[a-z0-9]*+(?: [a-z0-9]++){{0,{n}}}+" for n in (tokens - 1, tokens + length - 2))
    return F.regexp_extract_all(text, F.lit(f"(?:(?<=[a-z0-9]) )?(?=({longer})){own}"), 1)


def phrases(text: Column, length: int = PHRASE_LENGTH) -> Column:
    """All runs of `length` tokens of a normalized text, in text order.

    One pass of a look-ahead at every token start: the match itself takes the token and
    the space behind it, so that nothing is tried within a token. Only the first token of a
    text can be empty. The quantifiers are possessive, so the cost per token is
    the length of its phrase whatever the text looks like.
    """
    run = "[a-z0-9]*+" + " [a-z0-9]++" * (length - 1)
    return F.regexp_extract_all(text, F.lit(f"(?<![a-z0-9])(?=({run}))[a-z0-9]*+ ?"), 1)

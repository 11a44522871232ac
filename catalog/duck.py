"""DuckDB text of the deterministic draws."""

from __future__ import annotations

from millrace.functions.draws import DIGIT_LETTER, LETTERS_PER_HASH, PRIMES, SIGN_LETTER, Draws
from millrace.sources.generator import FRESH_PER_TEN_THOUSAND, GeneratorOptions, repeated_text

DRAWS = Draws(42)


def lanes(source: str, row_id: str, seed: int = 42) -> str:
    """Subquery: the source's columns plus row hash and lanes."""
    return f"""(SELECT *, ('0x' || substr(_row_hash, 1, 8))::BIGINT % {PRIMES[0]} AS _lane_a,
        ('0x' || substr(_row_hash, 9, 8))::BIGINT % {PRIMES[1]} AS _lane_b
      FROM (SELECT *, md5('{seed}|' || {row_id}::VARCHAR) AS _row_hash FROM {source}))"""


def letters_from(text: str, length: str) -> str:
    def chunk(number: int) -> str:
        raw = f"to_base64(unhex(sha256({text} || '|{number}')))"
        plain = f"regexp_replace(regexp_replace({raw}, '[0-9]', '{DIGIT_LETTER}', 'g'), '[+/=]', '{SIGN_LETTER}', 'g')"
        return f"substr({plain}, 1, {LETTERS_PER_HASH})"

    return f"substr({chunk(0)} || {chunk(1)}, 1, CAST({length} AS INT))"


def letters(path: str, length: str, pos: str | None = None) -> str:
    text = f"_row_hash || '|{path}'" + (f" || '|' || CAST({pos} AS VARCHAR)" if pos else "")
    return letters_from(text, length)


def text(path: str, name: str, options: GeneratorOptions, pos: str | None = None) -> str:
    """A generated string: fresh, or the field's repeated value."""
    drawn = DRAWS.number(path + "*", pos)
    length = f"({drawn} // 10000 % {options.max_chars - options.min_chars} + {options.min_chars})"
    return (
        f"CASE WHEN {drawn} % 10000 < {FRESH_PER_TEN_THOUSAND} "
        f"THEN {letters(path, length, pos)} ELSE '{repeated_text(options, name)}' END"
    )


def size(path: str, most: int, smallest: int = 1) -> str:
    return f"greatest({DRAWS.below(most, path + '%')}, {smallest})"

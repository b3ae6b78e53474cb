"""Name variants, content checks and small helpers of generated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SENTENCE_END, squeeze

# Substitutions in their order, consonants, and the words that mark English text.
SUBSTITUTIONS = (("z", "s"), ("s", "z"), ("c", "k"), ("k", "c"), ("i", "y"), ("y", "i"), ("ph", "f"), ("f", "ph"), ("ck", "k"))
CONSONANTS = "bcdfghjklmnpqrstvwxyz"


def nicknames(first: Column) -> Column:
    """Prefixes of four, five and three letters of a name of more than four, and the name without a Greek ending."""
    n = F.length(first)
    prefixes = F.array(*[F.when(n > k, F.left(first, F.lit(k))) for k in (4, 5, 3)])
    endings = F.array(F.when(F.regexp_like(first, F.lit("(?:as|os|us)$")) & (n > 5), F.left(first, n - 2)), F.when(F.endswith(first, F.lit("olas")) & (n > 6), F.left(first, n - 4)))
    return F.when(n > 4, F.array_distinct(F.array_compact(F.concat(prefixes, endings)))).otherwise(F.array().cast("array<string>"))


def misspellings(name: Column) -> Column:
    """One substitution each at its first place, in order, and the first inner consonant doubled."""
    low = F.lower(name)

    def swap(source: str, target: str) -> Column:
        at = F.instr(low, source)
        part = F.substring(name, at, F.lit(len(source)))
        upper = F.upper(part) == part
        cased = F.when(upper, F.lit(target.upper())).when(F.upper(F.left(part, F.lit(1))) == F.left(part, F.lit(1)), F.lit(target.capitalize())).otherwise(F.lit(target))
        return F.when(at > 0, F.concat(F.left(name, at - 1), cased, F.substring(name, at + len(source), F.lit(2**31 - 1))))

    doubled = F.regexp_replace(name, rf"(?i)^(.[^{CONSONANTS}]*)([{CONSONANTS}])", "$1$2$2")
    every = F.array_compact(F.array(*[swap(*s) for s in SUBSTITUTIONS], F.when(doubled != name, doubled)))
    return unique_fold(every)


def unique_fold(values: Column) -> Column:
    """Values without those that equal an earlier one in any case."""
    return F.filter(values, lambda v, i: ~F.exists(F.slice(values, F.lit(1), i), lambda w: F.lower(w) == F.lower(v)) | (i == 0))


def add_variants(existing: Column, candidates: Column, most: int) -> Column:
    """The first ``most`` candidates that are not blank, known or repeated in any case."""
    fresh = F.filter(unique_fold(candidates), lambda c: (F.trim(c) != "") & ~F.exists(existing, lambda e: F.lower(e) == F.lower(c)))
    return F.slice(fresh, 1, most)


def drop_repeats(text: Column, line_least: int = 80, sentence_least: int = 90) -> Column:
    """Text without repeated long lines and sentences; a line that repeats the one before goes at any length."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.rtrim(x))
    key = lambda x: F.lower(squeeze(x))
    def stays(x: Column, i: Column) -> Column:
        before = F.slice(lines, F.lit(1), i)
        last = F.get(lines, i - 1)
        long = (F.length(key(x)) >= line_least) & F.exists(before, lambda b: key(b) == key(x))
        return (i == 0) | ~(long | (F.coalesce(key(last), F.lit("")) == key(x)))

    kept = F.array_join(F.filter(lines, stays), "\n")
    parts = F.split(squeeze(kept), SENTENCE_END)
    once = F.filter(parts, lambda s, i: (i == 0) | (F.length(s) < sentence_least) | ~F.exists(F.slice(parts, F.lit(1), i), lambda b: F.lower(b) == F.lower(s)))
    return F.trim(F.array_join(once, " "))


def end_sentence(text: Column) -> Column:
    """Text with a full stop unless it ends in punctuation; blank stays blank."""
    bare = F.rtrim(text)
    return F.when(bare == "", bare).when(F.regexp_like(bare, F.lit(r"[.!?]$")), bare).otherwise(F.concat(bare, F.lit(".")))


def output_budget(words: Column, multiplier: float, least: int, most: int) -> Column:
    return F.greatest(F.lit(least), F.least(F.lit(most), F.floor(words * F.lit(multiplier)).cast("int")))


def prompt_words(target: Column) -> Column:
    """Words to ask for: the target with a buffer of eight per cent, twenty-five at least."""
    return target + F.greatest(F.lit(25), F.floor(target * F.lit(0.08)).cast("int"))


def content_problems(text: Column, least: int, most: int, required: tuple[str, ...] = (), forbidden: tuple[str, ...] = (), sentences: int = 4) -> Column:
    """What a text lacks: word count, sentences, required terms, or which forbidden ones it has."""
    words = F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)))
    low = F.lower(text)
    said = [F.when((words < least) | (words > most), F.format_string("word count %d", words)), F.when(F.size(F.regexp_extract_all(text, F.lit(r"[.!?](?:\s|$)"), F.lit(0))) < sentences, F.lit("too few sentences"))]
    said += [F.when(~F.contains(low, F.lit(t.lower())), F.lit(f"missing {t}")) for t in required]
    said += [F.when(F.contains(low, F.lit(t.lower())), F.lit(f"forbidden {t}")) for t in forbidden]
    return F.array_compact(F.array(*said))


def observation_url(trace: Column, observation: Column) -> Column:
    mark = F.when(F.contains(trace, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.when((F.coalesce(trace, F.lit("")) != "") & (F.coalesce(observation, F.lit("")) != ""), F.concat(trace, mark, F.lit("observation="), observation))


def is_version(text: Column) -> Column:
    return F.regexp_like(text, F.lit(r"^\d+\.\d+\.\d+$"))


def usage_total(prompt: Column, response: Column) -> Column:
    """Sum of two token counts, null unless both are there."""
    return prompt + response

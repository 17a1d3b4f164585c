"""Similarity of two names: 0-100 from their longest common subsequence (LCS).

score = 100 * 2*LCS / (len a + len b), rounded half to even. The LCS is bit-parallel (Hyyrö 2004): for
each character of the left name bit masks hold its positions, WORD to a BIGINT, and the loop over the
right name's characters updates as many BIGINTs as the left name fills, passing on the carry. One that
fills a single BIGINT needs no carry. Everything is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import bind

WORD = 60


def chars(c: Column) -> Column:
    return F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))


def char_masks(c: Column) -> Column:
    """MAP<character, ARRAY<BIGINT>> of its positions, WORD positions to a number; NULL for empty names."""
    def mask(letters: Column, word: Column, ch: Column) -> Column:
        first = word * WORD
        return F.aggregate(
            F.sequence(first, F.least(first + WORD, F.size(letters)) - 1), F.lit(0).cast("bigint"),
            lambda m, i: F.when(F.get(letters, i) == ch, m.bitwiseOR(_bit(i - first))).otherwise(m))

    def masks(letters: Column) -> Column:
        words = F.sequence(F.lit(0), _words(F.size(letters)) - 1)
        return bind(F.array_distinct(letters), lambda kinds: F.map_from_arrays(
            kinds, F.transform(kinds, lambda ch: F.transform(words, lambda w: mask(letters, w, ch)))))

    return F.when(F.length(c) > 0, bind(F.split(c, ""), masks))


def _words(length: Column) -> Column:
    return F.ceil(length / WORD).cast("int")


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def _full(length: Column) -> Column:
    return _bit(length) - F.lit(1).cast("bigint")


def _lcs_one_word(masks: Column, la: Column, b: Column) -> Column:
    steps = F.transform(chars(b), lambda ch: F.coalesce(F.get(F.try_element_at(masks, ch), F.lit(0)), F.lit(0).cast("bigint")))
    left = F.aggregate(
        steps, _full(la),
        lambda v, m: (v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(_full(la)))
    return la - F.bit_count(left)


def _lcs_many_words(masks: Column, la: Column, b: Column) -> Column:
    words = F.sequence(F.lit(0), _words(la) - 1)
    zero, none = F.lit(0).cast("bigint"), F.array().cast("array<bigint>")
    start = F.transform(words, lambda w: _full(F.least(F.lit(WORD), la - w * WORD)))

    def step(state: Column, ch: Column) -> Column:
        def word(done: Column, w: Column) -> Column:
            v, m = F.get(state, w), F.coalesce(F.get(F.try_element_at(masks, ch), w), zero)
            total = v + v.bitwiseAND(m) + done["carry"]
            new = total.bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(_full(F.least(F.lit(WORD), la - w * WORD)))
            return F.struct(F.shiftright(total, WORD).alias("carry"), F.array_append(done["out"], new).alias("out"))

        return F.aggregate(words, F.struct(zero.alias("carry"), none.alias("out")), word, lambda done: done["out"])

    left = F.aggregate(chars(b), start, step)
    return la - F.aggregate(left, F.lit(0), lambda n, v: n + F.bit_count(v))


def lcs_length(a: Column, b: Column, masks: Column | None = None) -> Column:
    """Length of the longest common subsequence; `masks` may be a column with `char_masks(a)`."""
    la = F.length(a)

    def by_masks(m: Column) -> Column:
        return F.when(la <= WORD, _lcs_one_word(m, la, b)).otherwise(_lcs_many_words(m, la, b))

    return (
        F.when((la == 0) | (F.length(b) == 0), F.lit(0))
        .when(a == b, la)
        .otherwise(bind(char_masks(a), by_masks) if masks is None else by_masks(masks))
    )


def similarity(a: Column, b: Column, masks: Column | None = None) -> Column:
    """0-100; equal names 100 (two empty names too), one empty name 0."""
    total = F.length(a) + F.length(b)
    share = F.lit(1.0) - (total - 2 * lcs_length(a, b, masks)) / total
    return F.when(a == b, F.lit(100)).otherwise(F.rint(F.lit(100.0) * share).cast("int"))


def letter_bits(c: Column) -> Column:
    """BIGINT telling which letters a-z occur once and twice and which digits occur, one bit each."""
    def step(bits: Column, ch: Column) -> Column:
        letter = F.call_function("instr", F.lit("abcdefghijklmnopqrstuvwxyz"), ch)
        digit = F.call_function("instr", F.lit("0123456789"), ch)
        once = _bit((letter - 1) * 2)
        again = F.when(bits.bitwiseAND(once) == 0, once).otherwise(_bit((letter - 1) * 2 + 1))
        return F.when(letter > 0, bits.bitwiseOR(again)).when(digit > 0, bits.bitwiseOR(_bit(digit + 51))).otherwise(bits)

    return F.aggregate(chars(c), F.lit(0).cast("bigint"), step)


def may_reach(score: int, a: Column, a_bits: Column, b: Column, b_bits: Column) -> Column:
    """FALSE only if the two names cannot score `score`: they have too few characters in common.

    Characters both bit sets show are counted exactly; of those a bit set does not show, no more can
    be common than the poorer name has.
    """
    shown = F.bit_count(a_bits.bitwiseAND(b_bits))
    hidden = F.least(F.length(a) - F.bit_count(a_bits), F.length(b) - F.bit_count(b_bits))
    return 400 * (shown + hidden) >= (2 * score - 1) * (F.length(a) + F.length(b))

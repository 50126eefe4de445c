"""Stems as column expressions.

``english_stem`` applies the Porter rules (the default English stemmer of the
analyser), ``russian_stem`` the Snowball rules for Russian with their regions,
both without a library or a Python function.  They are meant for the distinct
terms of a corpus (``text_index.analysed_tokens`` joins them to the tokens).
Every step binds its input to a lambda variable, so the expression grows by
one step at a time, also where the optimiser moves it into a filter.

A null term has no stem.  Terms in other scripts hold no suffix of the rules and
are their own stems, as are English terms of one or two letters and Russian ones without a
vowel.  Terms are expected in lower case, as the analyser makes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the suffixes of the Porter rules ---------------------------------
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
          "iti", "ous", "ive", "ize")
# ---- fixed values: the endings of the Russian Snowball rules ------------------------
AFTER_A = "ая"                     # first groups stand behind one of these
GERUND = ("в вши вшись", "ив ивши ившись ыв ывши ывшись")
ADJECTIVE = "ее ие ые ое ими ыми ей ий ый ой ем им ым ом его ого ему ому их ых ую юю ая яя ою ею"
PARTICIPLE = ("ем нн вш ющ щ", "ивш ывш ующ")
REFLEXIVE = "ся сь"
VERB = ("ла на ете йте ли й л ем н ло но ет ют ны ть ешь нно",
        "ила ыла ена ейте уйте ите или ыли ей уй ил ыл им ым ен ило ыло ено ят ует уют ит ыт ены ить ыть ишь ую ю")
NOUN = "а ев ов ие ье е иями ями ами еи ии и ией ей ой ий й иям ям ием ем ам ом о у ах иях ях ы ь ию ью ю ия ья я"
DERIVATIONAL = "ост ость"
SUPERLATIVE = "ейш ейше"
# --------------------------------------------------------------------------------------

# in a marked word a consonant y is a capital Y, so a vowel is one of:
_V, _C = "[aeiouy]", "[^aeiouy]"
ONE = f"{_V}{_C}"                          # at least one vowel-consonant sequence
TWO = f"{_V}{_C}+{_V}+{_C}"                # at least two
SHORT = f"{_C}{_V}[^aeiouywxY]$"           # consonant, vowel, consonant other than w, x, y


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.char_length(word) - n)


def _longest(word: Column, rules: dict[str, str], measure: str) -> Column:
    """The longest suffix that fits is replaced if what precedes it has the measure; else nothing changes."""
    out = None
    for suffix in sorted(rules, key=len, reverse=True):
        stem = _without(word, len(suffix))
        enough = stem.rlike(measure)
        if suffix == "ion":
            enough = enough & stem.rlike("[st]$")
        done = F.when(enough, F.concat(stem, F.lit(rules[suffix]))).otherwise(word)
        out = (F if out is None else out).when(word.endswith(suffix), done)
    return out.otherwise(word)


def _plural(w: Column) -> Column:
    return F.when(w.endswith("sses") | w.endswith("ies"), _without(w, 2)) \
        .when(w.endswith("s") & ~w.endswith("ss"), _without(w, 1)).otherwise(w)


def _mended(cut: Column) -> Column:
    """The end of a word that lost -ed or -ing."""
    return (F.when(cut.rlike("(at|bl|iz)$"), F.concat(cut, F.lit("e")))
            .when(cut.rlike(f"({_C})\\1$"), F.when(cut.rlike("[lsz]$"), cut).otherwise(_without(cut, 1)))
            .when(cut.rlike(ONE) & ~cut.rlike(TWO) & cut.rlike(SHORT), F.concat(cut, F.lit("e"))).otherwise(cut))


def _past(w: Column) -> Column:
    kept = F.when(w.endswith("eed") & _without(w, 3).rlike(ONE), _without(w, 1)).otherwise(w)
    cut = F.when(w.endswith("eed"), F.lit(None)).when(w.endswith("ed"), _without(w, 2)).when(w.endswith("ing"), _without(w, 3))
    return _let(cut, lambda c: F.when(F.coalesce(c.rlike(_V), F.lit(False)), _mended(c)).otherwise(kept))


def _last_letters(w: Column) -> Column:
    base = _without(w, 1)
    silent = w.endswith("e") & (base.rlike(TWO) | base.rlike(ONE) & ~base.rlike(SHORT))
    return _let(F.when(silent, base).otherwise(w), lambda x: F.when(x.endswith("ll") & x.rlike(TWO), _without(x, 1)).otherwise(x))


def english_stem(term: Column) -> Column:
    steps = (
        _plural, _past,
        lambda w: F.when(w.rlike(f"{_V}.*[yY]$"), F.concat(_without(w, 1), F.lit("i"))).otherwise(w),
        lambda w: _longest(w, STEP_2, ONE), lambda w: _longest(w, STEP_3, ONE),
        lambda w: _longest(w, dict.fromkeys(STEP_4, ""), TWO), _last_letters)
    word = F.regexp_replace(F.regexp_replace(term, "(^|[aeiou])y", "$1Y"), "yy", "yY")
    for step in steps:
        word = _let(word, step)
    return F.when(F.char_length(term) <= 2, term).otherwise(F.translate(word, "Y", "y"))


def _ending(*groups: str) -> str:
    """A pattern for an ending of a region: the leftmost match is the longest ending."""
    alternatives = "|".join(groups[-1].split())
    if len(groups) == 2:
        alternatives += f"|(?<=[{AFTER_A}])(?:{'|'.join(groups[0].split())})"
    return f"(?:{alternatives})$"


def _drop(text: Column, *groups: str) -> Column:
    return F.regexp_replace(text, _ending(*groups), "")


def _inflection(rv: Column) -> Column:
    """The region without its gerund, or without its reflexive and adjectival, verbal or nominal ending."""
    def other(plain):
        def adjectival(x):
            verbal = _let(_drop(plain, *VERB), lambda y: F.when(y != plain, y).otherwise(_drop(plain, NOUN)))
            return F.when(x != plain, _drop(x, *PARTICIPLE)).otherwise(verbal)
        return _let(_drop(plain, ADJECTIVE), adjectival)

    return _let(_drop(rv, *GERUND), lambda g: F.when(g != rv, g).otherwise(_let(_drop(rv, REFLEXIVE), other)))


def _tidied(rv: Column) -> Column:
    return _let(_drop(rv, SUPERLATIVE), lambda cut: F.when(cut.endswith("нн"), _without(cut, 1))
                .when(cut != rv, cut).otherwise(F.regexp_replace(rv, "ь$", "")))


def russian_stem(term: Column) -> Column:
    v, c = "[аеиоуыэюя]", "[^аеиоуыэюя]"

    def of(word):
        # endings are looked for behind the first vowel; derivational ones also behind the second such place
        head = F.regexp_extract(word, f"^{c}*{v}", 0)
        far = F.char_length(F.regexp_extract(word, f"^{c}*{v}+{c}+{v}+{c}", 0))

        def underived(rv):
            return _let(_drop(rv, DERIVATIONAL), lambda cut: F.when(
                (far > 0) & (F.char_length(head) + F.char_length(cut) >= far), cut).otherwise(rv))

        region = F.substring(word, F.char_length(head) + 1, F.char_length(word))
        for step in (_inflection, lambda rv: F.regexp_replace(rv, "и$", ""), underived, _tidied):
            region = _let(region, step)
        return F.when(head == "", word).otherwise(F.concat(head, region))

    return _let(F.translate(term, "ё", "е"), of)

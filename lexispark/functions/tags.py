"""Tag classes (B11) and the one-string encoding of a tagged sequence.

A comment's tagged sequence is encoded once as a string in which every token
is ``" " + <class letter> + <value>``. Values never contain a space (they come
from splitting on one space), so a space always starts a token and the class
letter is the first character after it. The sequence operators (D1-D4) are
then leftmost, non-overlapping regular-expression matches over that string:
JVM-native, one pass per comment, no shuffle and no per-token interpreted
fold.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import col

ORGANIZATION = "ORGANIZATION"

# Tag families, tested as whole-string prefixes of the tag
# (``RB.*`` etc.), so ``WRB`` is not an adverb.
ADVERB, ADJECTIVE, CONJUNCTION, NOUN, VERB = "RB", "JJ", "CC", "NN", "VB"
PREPOSITION, DETERMINER = "IN", "DT"
BE = "be"

# Class letters used in the encoded string.
#   R adverb  J adjective  C conjunction  N noun
#   B verb whose value is "be"  V other verb  D preposition/determiner  X other
#   G organization token  O any other entity label
CLASS_LETTERS = "RJCNBVDXGO"


def tag_class(tag, value) -> Column:
    t, v = col(tag), col(value)
    return (F.when(t.startswith(ADVERB), "R")
            .when(t.startswith(ADJECTIVE), "J")
            .when(t.startswith(CONJUNCTION), "C")
            .when(t.startswith(NOUN), "N")
            .when(t.startswith(VERB) & (v == BE), "B")
            .when(t.startswith(VERB), "V")
            .when(t.startswith(PREPOSITION) | t.startswith(DETERMINER), "D")
            .otherwise("X"))


def ent_class(ent) -> Column:
    return F.when(col(ent) == ORGANIZATION, "G").otherwise("O")


def encode_tags(tags, values) -> Column:
    """Encode parallel ``tags`` / ``values`` arrays (equal length)."""
    return F.concat_ws("", F.zip_with(
        col(tags), col(values),
        lambda t, v: F.concat(F.lit(" "), tag_class(F.coalesce(t, F.lit("")), v), F.coalesce(v, F.lit("")))))


def encode_ents(ents, values) -> Column:
    return F.concat_ws("", F.zip_with(
        col(ents), col(values),
        lambda e, v: F.concat(F.lit(" "), ent_class(F.coalesce(e, F.lit(""))), F.coalesce(v, F.lit("")))))


def decode(fragment) -> Column:
    """Words of an encoded fragment (leading space included) joined by one
    space, class letters removed."""
    return F.regexp_replace(F.substring(col(fragment), 2, 1 << 30), f"(^| )[{CLASS_LETTERS}]", "$1")

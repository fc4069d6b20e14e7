"""Text annotation (C1-C5): tokens, part-of-speech tags, lemmas, entities.

The contract is four aligned arrays per text. Two interchangeable backends:

* ``annotate`` - a ``Lexicon`` (word table + ordered suffix rules +
  gazetteers of words and phrases) applied row-locally, no shuffle. Two
  evaluations of the same rule table: ``backend="arrow"`` (default) looks all
  tokens of a record batch up with vectorized Arrow kernels via ``mapInArrow``,
  one pass for a rule and one for the whole word table, whatever its size;
  ``backend="expr"`` renders it into ``CASE`` / ``IN`` expressions applied with
  ``transform`` (built-ins only, but lambdas run interpreted) and is meant for
  small lexicons (``MAX_INLINE_WORDS``). Both give identical output (tests).
* ``annotate_with_table`` - the word table as a DataFrame, joined: for lexicons
  too large to send to every task.
* ``annotate_with_tagger`` - a caller-supplied Python tagger run by
  ``mapInArrow``, built once per worker process, for real statistical taggers.
  Spark still partitions the texts; a text that the tagger fails on becomes an
  error row.

Gazetteers too large for a ``Lexicon`` are in ``gazetteer``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions._util import col
from ..functions.text import clean
from ..plans.stages import materialize

# Tokenizer. Clitics are cut off their word first ("do n't",
# "car 's"). A token is an abbreviation with its dot, a clitic, a decimal number,
# a run of ASCII letters/digits, or any other non-space character (the text is
# cleaned to printable ASCII first, so a space is the only separator left).
CLITIC_PATTERN = r"(?i)(n't|'(?:s|m|d|re|ve|ll))\b"
TOKEN_PATTERN = (r"\b(?:Corp|Inc|Ltd|Mr|Mrs|Dr)\.|(?i:n't|'(?:s|m|d|re|ve|ll))\b|[0-9]+(?:\.[0-9]+)+"
                 r"|[A-Za-z0-9]+|[^A-Za-z0-9 ]")
NUMBER_PATTERN = r"[0-9]+(?:\.[0-9]+)*"
NUMBER_TAG = "CD"
OUTSIDE = "O"
MAX_INLINE_WORDS = 5000


@dataclass(frozen=True)
class Lexicon:
    """Rule table of the lexicon backend.

    Rules for a token ``t`` (``l`` = lower case of ``t``), first match wins:
    one non-alphanumeric character -> the character itself as tag; ``l`` in
    ``words`` -> its tag; all digits -> ``CD``; ``suffix_rules`` in order
    (``l`` ends with the suffix; a noun-tag rule gives ``proper_tag`` when
    ``t`` starts with a capital); ``l`` longer than ``long_word[0]`` ->
    ``long_word[1]``; else ``default_tag``.
    Lemma: the ``words`` lemma, else ``t`` for ``proper_tag``, else ``l`` after
    the first fitting rule of ``lemma_suffixes`` (suffix, replacement).
    Entity: first gazetteer (in order) with a word or phrase (tokens joined by
    one space, case ignored) that covers the token, else ``O``.
    """

    words: Mapping[str, tuple[str, str]]
    suffix_rules: Sequence[tuple[str, str]] = ()
    long_word: tuple[int, str] | None = None
    default_tag: str = "NN"
    noun_tag: str = "NN"
    proper_tag: str | None = None
    gazetteers: Sequence[tuple[str, Sequence[str]]] = field(default_factory=tuple)
    lemma_suffixes: Sequence[tuple[str, str]] = ()

    def check_inline(self) -> None:
        if len(self.words) + sum(len(w) for _, w in self.gazetteers) > MAX_INLINE_WORDS:
            raise ValueError("lexicon too large for inline expressions; use the Arrow backend")

    def phrases(self) -> list[tuple[str, dict[int, list[str]]]]:
        """Each gazetteer's entries by their number of tokens."""
        out = []
        for label, entries in self.gazetteers:
            by: dict[int, set[str]] = {}
            for e in entries:
                tokens = e.lower().split()
                if tokens:
                    by.setdefault(len(tokens), set()).add(" ".join(tokens))
            out.append((label, {n: sorted(v) for n, v in sorted(by.items())}))
        return out

    def words_by_tag(self) -> list[tuple[str, list[str]]]:
        out: dict[str, list[str]] = {}
        for w, (tag, _) in self.words.items():
            out.setdefault(tag, []).append(w.lower())
        return [(k, sorted(v)) for k, v in out.items()]

    def words_by_lemma(self) -> list[tuple[str, list[str]]]:
        out: dict[str, list[str]] = {}
        for w, (_, lemma) in self.words.items():
            if lemma != w.lower():
                out.setdefault(lemma, []).append(w.lower())
        return [(k, sorted(v)) for k, v in out.items()]


def _lex(words: dict[str, str], lemmas: dict[str, str] | None = None) -> dict[str, tuple[str, str]]:
    lemmas = lemmas or {}
    return {w: (t, lemmas.get(w, w)) for w, t in words.items()}


# The test lexicon for the synthetic corpus tables.
_TEST_WORDS = {
    "the": "DT", "a": "DT", "an": "DT", "this": "DT", "that": "DT",
    "and": "CC", "or": "CC", "but": "CC",
    "of": "IN", "in": "IN", "on": "IN", "by": "IN", "for": "IN", "with": "IN",
    "at": "IN", "from": "IN", "as": "IN", "to": "IN",
    "is": "VBZ", "was": "VBD", "are": "VBP", "be": "VB", "were": "VBD",
    "it": "PRP", "he": "PRP", "she": "PRP",
    "not": "RB", "very": "RB",
}
_TEST_LEMMAS = {"is": "be", "was": "be", "are": "be", "were": "be"}
_TEST_SUFFIXES = (
    ("ly", "RB"),
    ("ing", "VBG"),
    ("ble", "JJ"), ("est", "JJ"), ("ed", "JJ"),
    ("tion", "NN"), ("er", "NN"), ("an", "NN"), ("ea", "NN"), ("nicht", "NN"),
    ("mente", "NN"), ("ment", "NN"), ("eau", "NN"), ("en", "NN"),
)
_TEST_ORGANIZATIONS = (
    "thtion", "attion", "ertion", "thanea", "eriner", "antion", "ontion",
    "retion", "nicht", "ention", "edtion",
)

TEST_LEXICON = Lexicon(
    words=_lex(_TEST_WORDS, _TEST_LEMMAS),
    suffix_rules=_TEST_SUFFIXES,
    long_word=(6, "JJ"),
    default_tag="FW",
    noun_tag="NN",
    proper_tag="NNP",
    gazetteers=(("ORGANIZATION", _TEST_ORGANIZATIONS),),
)


# Two gazetteers for the test tables, one of phrases, in priority order.
PHRASE_LEXICON = replace(TEST_LEXICON, gazetteers=(
    ("PLACE", ("of the", "in the", "the thtion", "de la", "von der")),
    ("ORGANIZATION", (*_TEST_ORGANIZATIONS, "of", "the and")),
))


#: Bytes of a lexicon file that is read on the driver and sent with each task.
LEXICON_BYTES = 64 << 20


def _bounded_lines(spark, path: str, beyond: str) -> list:
    lines = spark.read.text(path)
    size = lines.agg(F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).collect()[0][0]
    if size > LEXICON_BYTES:
        raise ValueError(f"{path} holds {size} bytes, over {LEXICON_BYTES}: {beyond}")
    return lines.collect()


def read_gazetteer(spark, gazetteers: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """LABEL=path files, one word or phrase a line, as a table (label, phrase) and
    the labels in order; nothing is collected."""
    pairs = [g.split("=", 1) for g in gazetteers]
    frames = [spark.read.text(path).select(F.lit(label).alias("label"), F.col("value").alias("phrase")) for label, path in pairs]
    table = frames[0]
    for f in frames[1:]:
        table = table.unionByName(f)
    return table, list(dict.fromkeys(label for label, _ in pairs))


def read_lexicon(spark, words: str, gazetteers: Sequence[str] = (), base: Lexicon | None = None) -> Lexicon:
    """A lexicon from files (any path Spark reads). ``words``: tab-separated
    word, tag, lemma (may be missing); lines ``-suffix tag`` are suffix rules in
    order. ``gazetteers``: LABEL=path, one word or phrase a line, first wins."""
    base = base or Lexicon(words={})
    table, suffixes = dict(base.words), list(base.suffix_rules)
    for r in _bounded_lines(spark, words, "annotate_with_table joins a table of words of any size"):
        parts = [x.strip() for x in r[0].split("\t")]
        if len(parts) < 2 or not parts[0]:
            continue
        if parts[0].startswith("-") and len(parts[0]) > 1:
            suffixes.append((parts[0][1:].lower(), parts[1]))
        else:
            table[parts[0].lower()] = (parts[1], parts[2] if len(parts) > 2 and parts[2] else parts[0].lower())
    hint = "gazetteer.annotate_with_gazetteer takes a table of phrases of any size"
    lists = [(label, tuple(r[0].strip() for r in _bounded_lines(spark, path, hint) if r[0].strip()))
             for label, path in (g.split("=", 1) for g in gazetteers)]
    return replace(base, words=table, suffix_rules=tuple(suffixes), gazetteers=tuple(lists) or base.gazetteers)


# ---------------------------------------------------------------- expressions

def _is_punct(t: Column) -> Column:
    return (F.length(t) == 1) & ~t.rlike("^[A-Za-z0-9]$")


def _capitalized(t: Column) -> Column:
    first = F.substring(t, 1, 1)
    return (first >= F.lit("A")) & (first <= F.lit("Z"))


def tag_of(lex: Lexicon, t: Column) -> Column:
    l = F.lower(t)
    e = F.when(_is_punct(t), t)
    for tag, words in lex.words_by_tag():
        e = e.when(l.isin(words), F.lit(tag))
    e = e.when(t.rlike(f"^{NUMBER_PATTERN}$"), F.lit(NUMBER_TAG))
    for suffix, tag in lex.suffix_rules:
        hit = l.endswith(suffix)
        if tag == lex.noun_tag and lex.proper_tag:
            e = e.when(hit & _capitalized(t), F.lit(lex.proper_tag))
        e = e.when(hit, F.lit(tag))
    if lex.long_word:
        e = e.when(F.length(l) > lex.long_word[0], F.lit(lex.long_word[1]))
    return e.otherwise(F.lit(lex.default_tag))


def lemma_of(lex: Lexicon, t: Column, tag: Column) -> Column:
    l = F.lower(t)
    e = None
    for lemma, words in lex.words_by_lemma():
        cond = l.isin(words)
        e = F.when(cond, F.lit(lemma)) if e is None else e.when(cond, F.lit(lemma))
    if lex.proper_tag:
        cond = tag == lex.proper_tag
        e = F.when(cond, t) if e is None else e.when(cond, t)
    known = sorted(w.lower() for w in lex.words)
    plain = F.when(l.isin(known), l) if known and lex.lemma_suffixes else None
    for suffix, new in lex.lemma_suffixes:
        cut = F.concat(F.substring(l, F.lit(1), F.length(l) - len(suffix)), F.lit(new))
        plain = F.when(l.endswith(suffix), cut) if plain is None else plain.when(l.endswith(suffix), cut)
    rest = l if plain is None else plain.otherwise(l)
    return rest if e is None else e.otherwise(rest)


def ents_of(lex: Lexicon, tokens: str) -> Column:
    """Entity of each token of an array: the first gazetteer with an entry that
    covers it."""
    low = F.transform(tokens, F.lower)

    def at(i: Column) -> Column:
        e = None
        for label, by in lex.phrases():
            cond = F.lit(False)
            for n, entries in by.items():
                for back in range(n):                    # entries that begin so far before it
                    start = i - back
                    own = F.array_join(F.slice(low, F.greatest(start, F.lit(0)) + 1, F.lit(n)), " ")
                    cond = cond | ((start >= 0) & own.isin(entries))
            e = F.when(cond, F.lit(label)) if e is None else e.when(cond, F.lit(label))
        return F.lit(OUTSIDE) if e is None else e.otherwise(F.lit(OUTSIDE))

    return F.transform(tokens, lambda _, i: at(i))


def tokens_of(text) -> Column:
    """C1 on raw text: clean (B5), cut clitics off, tokenize."""
    cut = F.regexp_replace(clean(col(text)), CLITIC_PATTERN, " $1")
    return F.regexp_extract_all(cut, F.lit(TOKEN_PATTERN), 0)


DEFAULT_BACKEND = "arrow"


def annotate(df: DataFrame, text_col: str, lex: Lexicon = TEST_LEXICON,
             prefix: str = "", backend: str | None = None) -> DataFrame:
    """Add ``tokens``, ``tags``, ``lemmas``, ``ents`` arrays (equal
    length) computed from ``text_col``. ``backend``: ``"arrow"`` (default,
    vectorized kernels per record batch) or ``"expr"`` (built-in expressions
    only); both give identical results."""
    if (backend or DEFAULT_BACKEND) == "arrow":
        out = annotate_arrow(df, text_col, lex)
        if prefix:
            out = out.withColumnsRenamed({n: prefix + n for n in ("tokens", "tags", "lemmas", "ents")})
        return out
    lex.check_inline()
    tk, tg, lm, en = (prefix + n for n in ("tokens", "tags", "lemmas", "ents"))
    return (df.withColumn(tk, tokens_of(text_col))
              .withColumn(tg, F.transform(tk, lambda t: tag_of(lex, t)))
              .withColumn(lm, F.zip_with(tk, tg, lambda t, g: lemma_of(lex, t, g)))
              .withColumn(en, ents_of(lex, tk)))


def annotation_strings(df: DataFrame, prefix: str = "") -> DataFrame:
    """C5 output form: the four arrays as space-joined strings."""
    return df.withColumns({prefix + n: F.array_join(prefix + n, " ")
                           for n in ("tokens", "lemmas", "tags", "ents")})


# --------------------------------------------------------- word table as a DataFrame

def annotate_with_table(df: DataFrame, text_col: str, table: DataFrame, lex: Lexicon) -> DataFrame:
    """C1-C4 with a word table (word, tag, lemma) of any size, joined: tokens are
    exploded, looked up and put back in their order. ``lex`` has the rules for
    words that the table lacks, and the gazetteers. Tokens are first counted
    down to distinct words, so a frequent word is looked up once and the join
    of the tokens with what was found is decided by its measured size."""
    own = materialize(df.withColumn("_row", F.monotonically_increasing_id())
                      .withColumn("tokens", tokens_of(text_col)).withColumn("ents", ents_of(lex, "tokens")), "tokens")
    words = own.select("_row", F.posexplode("tokens").alias("_at", "_t"))
    known = table.select(F.lower("word").alias("_w"), F.col("tag").alias("_tag"), F.col("lemma").alias("_lemma")).dropDuplicates(["_w"])
    found = materialize(words.select("_t").distinct().join(known, F.lower("_t") == F.col("_w"), "left")
                        .withColumn("_g", F.coalesce("_tag", tag_of(lex, F.col("_t"))))
                        .select("_t", "_g", F.coalesce("_lemma", lemma_of(lex, F.col("_t"), F.col("_g"))).alias("_l")), "found-words")
    back = (words.join(found, "_t").groupBy("_row")
            .agg(F.array_sort(F.collect_list(F.struct("_at", "_g", "_l"))).alias("_a")))
    empty = F.when(F.col("tokens").isNotNull(), F.array().cast("array<string>"))
    return own.join(back, "_row", "left").select(
        *df.columns, "tokens", F.coalesce(F.transform("_a", lambda x: x["_g"]), empty).alias("tags"),
        F.coalesce(F.transform("_a", lambda x: x["_l"]), empty).alias("lemmas"), "ents")


# --------------------------------------------------------- tagger backend

Tagger = Callable[[str], tuple[Sequence[str], Sequence[str], Sequence[str], Sequence[str]]]
#: Text bytes given out at once by the tagger backend (one row at least).
TAGGER_BYTES = 4 << 20
_TAGGERS: dict[str, Tagger] = {}


def _tagger(key: str, make_tagger: Callable[[], Tagger]) -> Tagger:
    """The worker's tagger: made once for each worker process, which tasks share."""
    if key not in _TAGGERS:
        _TAGGERS.clear()                                   # a worker keeps one model, the last in use
        _TAGGERS[key] = make_tagger()
    return _TAGGERS[key]


def _tagged_row(tagger: Tagger, text: str | None) -> tuple[list | None, str | None]:
    """Four lists and no error, or no lists and the error of one text."""
    try:
        lists = [[str(x) for x in part] for part in (tagger(text) if text is not None else ((), (), (), ()))]
        if len(lists) != 4 or len({len(x) for x in lists}) != 1:
            raise ValueError("a tagger returns tokens, lemmas, tags and ents of one length")
        return lists, None
    except Exception as e:  # noqa: BLE001
        return None, f"tagger failed: {type(e).__name__}: {e}"


def annotate_with_tagger(df: DataFrame, text_col: str, make_tagger: Callable[[], Tagger], prefix: str = "",
                         error_col: str = "tagger_error", max_bytes: int = TAGGER_BYTES) -> DataFrame:
    """C5 with a caller-supplied tagger, which maps cleaned text to (tokens,
    lemmas, tags, ents). ``make_tagger()`` runs once for each worker process, so a model
    is loaded once however many tasks the worker runs. What a tagger raises on
    one text (or ragged lists) becomes that row's ``error_col``, with null
    lists; other rows go on. Rows are given out in batches of at most ``max_bytes``
    of text, so that long texts do not pile up in a worker."""
    import uuid
    key = uuid.uuid4().hex
    names = [prefix + n for n in ("tokens", "lemmas", "tags", "ents")]
    arr = T.ArrayType(T.StringType())
    schema = T.StructType(df.schema.fields + [T.StructField(n, arr, True) for n in names]
                          + [T.StructField(error_col, T.StringType(), True)])
    cleaned = "__clean_text"

    def run(batches):
        import pyarrow as pa
        tagger = _tagger(key, make_tagger)

        def made(whole, start, rows):
            part = whole.slice(start, len(rows))
            lists = [pa.array([r[0] if r[0] is None else r[0][i] for r in rows], pa.list_(pa.string())) for i in range(4)]
            errors = pa.array([r[1] for r in rows], pa.string())
            own = [part.column(i) for i in range(part.num_columns) if part.schema.names[i] != cleaned]
            return pa.RecordBatch.from_arrays([*own, *lists, errors], names=schema.names)

        for b in batches:
            rows, start, size = [], 0, 0
            for text in b.column(cleaned):
                text = text.as_py()
                if rows and size + len(text or "") > max_bytes:
                    yield made(b, start, rows)
                    rows, start, size = [], start + len(rows), 0
                rows.append(_tagged_row(tagger, text))
                size += len(text or "")
            if rows:
                yield made(b, start, rows)

    return df.withColumn(cleaned, clean(text_col)).mapInArrow(run, schema)


# --------------------------------------------------------- Arrow backend
#
# The same rule table evaluated with vectorized Arrow compute kernels over
# whole record batches (``mapInArrow``): one pass per rule over all tokens of
# a batch, in C++, instead of an interpreted CASE per token. Spark reads and
# partitions; Python only sees Arrow buffers.

def _arrow_tags(lex: Lexicon, flat, low, table=None):
    import pyarrow as pa
    import pyarrow.compute as pc
    s = lambda v: pa.scalar(v, flat.type)
    out = pa.repeat(s(lex.default_tag), len(flat))
    if lex.long_word:
        out = pc.if_else(pc.greater(pc.utf8_length(low), lex.long_word[0]), s(lex.long_word[1]), out)
    cap = pc.match_substring_regex(flat, "^[A-Z]")
    for suffix, tag in reversed(list(lex.suffix_rules)):
        hit = pc.ends_with(low, suffix)
        out = pc.if_else(hit, s(tag), out)
        if tag == lex.noun_tag and lex.proper_tag:
            out = pc.if_else(pc.and_(hit, cap), s(lex.proper_tag), out)
    out = pc.if_else(pc.match_substring_regex(flat, f"^{NUMBER_PATTERN}$"), s(NUMBER_TAG), out)
    out = pc.coalesce(_from_table(_word_table(lex) if table is None else table, low, 0), out)
    punct = pc.and_(pc.equal(pc.utf8_length(flat), 1), pc.invert(pc.match_substring_regex(flat, "^[A-Za-z0-9]$")))
    return pc.if_else(punct, flat, out)


def _word_table(lex: Lexicon) -> dict[str, tuple[str, str]]:
    """The word table by lower-cased word; of words that differ by case, the first."""
    out: dict[str, tuple[str, str]] = {}
    for w, found in lex.words.items():
        out.setdefault(w.lower(), found)
    return out


def _from_table(table: Mapping[str, tuple[str, str]], low, part: int):
    """What the word table has for each token (0: tag, 1: lemma), else null."""
    import pyarrow as pa
    if not table:
        return pa.nulls(len(low), low.type)
    none = (None, None)
    return pa.array([table.get(t, none)[part] for t in low.to_pylist()], low.type)


def _arrow_lemmas(lex: Lexicon, flat, low, tags, table=None):
    import pyarrow as pa
    import pyarrow.compute as pc
    out = low
    for suffix, new in reversed(list(lex.lemma_suffixes)):
        cut = pc.binary_join_element_wise(pc.utf8_slice_codeunits(low, 0, -len(suffix)), pa.scalar(new, low.type), "")
        out = pc.if_else(pc.ends_with(low, suffix), cut, out)
    if lex.proper_tag:
        out = pc.if_else(pc.equal(tags, pa.scalar(lex.proper_tag, flat.type)), flat, out)
    # a listed word whose lemma is itself follows the proper-noun rule, as others do
    own = _from_table(_word_table(lex) if table is None else table, low, 1)
    same = pc.or_kleene(pc.is_null(own), pc.equal(own, low))
    out = pc.if_else(same, out, own)
    if lex.lemma_suffixes and lex.words:
        listed = pc.and_kleene(pc.is_valid(own), pc.equal(own, low))
        proper = pc.equal(tags, pa.scalar(lex.proper_tag or "", flat.type))
        out = pc.if_else(pc.and_kleene(pc.fill_null(listed, False), pc.invert(proper)), low, out)
    return out


def _phrase_sets(lex: Lexicon) -> list:
    """``lex.phrases()`` as Arrow strings, made once for a task."""
    import pyarrow as pa
    return [(label, {n: pa.array(entries, pa.string()) for n, entries in by.items()}) for label, by in lex.phrases()]


def _arrow_ents(lex: Lexicon, toks, low, phrases=None):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    n = len(low)
    offsets = pc.subtract(toks.offsets, toks.offsets[0]).to_numpy()
    row = np.repeat(np.arange(len(toks)), np.diff(offsets))
    out = pa.repeat(pa.scalar(OUTSIDE, low.type), n)
    for label, by in reversed(_phrase_sets(lex) if phrases is None else phrases):
        covered = np.zeros(n, bool)
        for size, entries in by.items():
            if size > n:
                continue
            last = n - size + 1
            grams = low if size == 1 else pc.binary_join_element_wise(*[low.slice(k, last) for k in range(size)], " ")
            hit = pc.is_in(grams, value_set=entries.cast(low.type)).to_numpy(zero_copy_only=False)
            hit &= row[:last] == row[size - 1:]
            for k in range(size):
                covered[k:k + last] |= hit
        out = pc.if_else(pa.array(covered), pa.scalar(label, low.type), out)
    return out


def _arrow_classes(tags, values):
    """Class letters of ``functions.tags.tag_class`` for flat tag/value arrays."""
    import pyarrow as pa
    import pyarrow.compute as pc
    s = lambda v: pa.scalar(v, tags.type)
    sw = lambda p: pc.starts_with(tags, p)
    out = pa.array(["X"] * len(tags), tags.type)
    rules = [("R", sw("RB")), ("J", sw("JJ")), ("C", sw("CC")), ("N", sw("NN")),
             ("B", pc.and_(sw("VB"), pc.equal(values, s("be")))), ("V", sw("VB")),
             ("D", pc.or_(sw("IN"), sw("DT")))]
    for letter, cond in reversed(rules):
        out = pc.if_else(cond, s(letter), out)
    return out


def _relist(like, values):
    import pyarrow as pa
    import pyarrow.compute as pc
    offsets = pc.subtract(like.offsets, like.offsets[0])
    return pa.ListArray.from_arrays(offsets, values, mask=like.is_null())


def _arrow_tokens(text):
    """C1 on an Arrow string array: clean (B5), cut clitics off, put spaces around
    every match of ``TOKEN_PATTERN`` (no token holds one), split on spaces, drop
    empty pieces."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from ..functions.text import STRIP_PATTERN
    cleaned = pc.replace_substring_regex(text, STRIP_PATTERN, " ")
    cut = pc.replace_substring_regex(cleaned, CLITIC_PATTERN, " \\1")
    spaced = pc.replace_substring_regex(cut, f"({TOKEN_PATTERN})", " \\1 ")
    pieces = pc.split_pattern(spaced, " ")
    flat = pc.list_flatten(pieces)
    keep = pc.greater(pc.utf8_length(flat), 0)
    parents = pc.list_parent_indices(pieces).to_numpy()
    counts = np.bincount(parents[keep.to_numpy(zero_copy_only=False)], minlength=len(text))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pc.filter(flat, keep), mask=text.is_null())


def _arrow_sentence(toks, values, is_org):
    """D4 sentence (``sequence.merged_values``): values joined by one space,
    except ``_`` between two consecutive ORGANIZATION tokens."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    n = len(values)
    org = pc.fill_null(is_org, False).to_numpy(zero_copy_only=False)
    offsets = pc.subtract(toks.offsets, toks.offsets[0]).to_numpy()
    first = np.zeros(n, dtype=bool)
    starts = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[starts] = True
    prev = np.concatenate([[False], org[:-1]]) if n else org
    cont = org & prev & ~first
    sep = pc.if_else(pa.array(first), pa.scalar("", values.type),
                     pc.if_else(pa.array(cont), pa.scalar("_", values.type), pa.scalar(" ", values.type)))
    pieces = pc.binary_join_element_wise(sep, values, pa.scalar("", values.type))
    return pc.binary_join(_relist(toks, pieces), "")


#: Bytes of text annotated at once (one row at least): the arrays of a text's tokens are
#: many times its size, so a whole record batch of long texts would fill a worker.
STEP_BYTES = 1 << 20


def _steps(batch, text_col: str, max_bytes: int):
    """A record batch in slices of at most ``max_bytes`` of text, or one row."""
    import numpy as np
    import pyarrow.compute as pc
    size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _arrow_annotator(lex: Lexicon, text_col: str, encode: bool, entities=None, max_bytes: int | None = None):
    def run(batches):
        table, phrases = _word_table(lex), None if entities else _phrase_sets(lex)
        for whole in batches:
            for b in _steps(whole, text_col, max_bytes or STEP_BYTES):
                yield annotated(b, table, phrases)

    def annotated(b, table, phrases):
        import pyarrow as pa
        import pyarrow.compute as pc
        toks = _arrow_tokens(b.column(text_col))
        flat = pc.list_flatten(toks)
        coded = pc.dictionary_encode(flat)                     # each distinct token is looked up once
        every, at = coded.dictionary, coded.indices
        lower = pc.utf8_lower(every)
        own_tags = _arrow_tags(lex, every, lower, table)
        own_lemmas = _arrow_lemmas(lex, every, lower, own_tags, table)
        low, tags, lemmas = lower.take(at), own_tags.take(at), own_lemmas.take(at)
        ents = entities(toks, low) if entities else _arrow_ents(lex, toks, low, phrases)
        cols = {"tokens": toks, "tags": _relist(toks, tags), "lemmas": _relist(toks, lemmas),
                "ents": _relist(toks, ents)}
        if encode:
            sp = pa.scalar(" ", flat.type)
            enc = pc.binary_join_element_wise(sp, _arrow_classes(own_tags, own_lemmas), own_lemmas, "").take(at)
            is_org = pc.equal(ents, pa.scalar("ORGANIZATION", flat.type))
            ecls = pc.if_else(is_org, pa.scalar("G", flat.type), pa.scalar("O", flat.type))
            enc_ents = pc.binary_join_element_wise(sp, ecls, lemmas, "")
            cols["enc"] = pc.binary_join(_relist(toks, enc), "")
            cols["enc_ents"] = pc.binary_join(_relist(toks, enc_ents), "")
            cols["sentence"] = _arrow_sentence(toks, lemmas, is_org)
        return pa.RecordBatch.from_arrays([*b.columns, *cols.values()], names=[*b.schema.names, *cols])

    return run


def annotate_arrow(df: DataFrame, text_col: str, lex: Lexicon = TEST_LEXICON, encode: bool = False,
                   entities=None) -> DataFrame:
    """C1-C4 with the Arrow backend: adds ``tokens``, ``tags``, ``lemmas``,
    ``ents`` (and, with ``encode``, the encoded strings ``enc`` / ``enc_ents``
    of ``functions.tags`` built from tags and lemmas, and the org-merged
    ``sentence`` of ``sequence.merged_values``). Same results as
    ``annotate``. ``entities(tokens, lower-cased flat tokens)`` takes the place of
    the lexicon's gazetteers (see ``gazetteer``)."""
    arr = T.ArrayType(T.StringType())
    fields = df.schema.fields + [T.StructField(n, arr, True) for n in ("tokens", "tags", "lemmas", "ents")]
    if encode:
        fields += [T.StructField(n, T.StringType(), True) for n in ("enc", "enc_ents", "sentence")]
    return df.mapInArrow(_arrow_annotator(lex, text_col, encode, entities), T.StructType(fields))

"""Part-of-speech tags through a pluggable tagger; the default is a lexicon with suffix rules, as one expression."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import mapped, quoted
from millrace.operators.tokenize import Tokenizer, TokenResources
from millrace.session import ship

SEPARATOR = "_"
LEXICON = {
    "DT": "the a an this that these those der die das ein eine le la les un une el los las una".split(),
    "IN": "of in on at by for with from to in von zu mit auf aus bei de du dans par pour avec con por para en".split(),
    "CC": "and or but und oder aber et ou mais y o pero".split(),
    "PRP": "i you he she it we they ich er sie es wir je tu il elle nous vous yo él ella".split(),
    "VBZ": "is are was were be has had have ist sind war hat est sont es son era".split(),
    "RB": "not very also nicht sehr auch ne pas très no muy también".split(),
}
#: (pattern, tag) tried in order on words that the lexicon doesn't have.
RULES = [
    (r"^\p{P}+$", "."),
    (r"^[+-]?\p{N}[\p{N}.,]*$", "CD"),
    (r"^\p{Lu}", "NNP"),
    (r"(ing)$", "VBG"),
    (r"(ed)$", "VBD"),
    (r"(ly|mente)$", "RB"),
    (r"(tion|heit|keit|ung|ción|ness|ment)$", "NN"),
    (r"(able|ible|ous|lich|isch|ig|ful)$", "JJ"),
    (r"s$", "NNS"),
]


def tag_of(word: Column) -> Column:
    """Tag of a word as a chain of conditions."""
    out = F.lit("NN")
    for pattern, tag in reversed(RULES):
        out = F.when(word.rlike(pattern), tag).otherwise(out)
    for tag, members in reversed(LEXICON.items()):
        out = F.when(word.isin(members), tag).otherwise(out)
    return out


def tag_of_sql(word: str) -> str:
    cases = [f"WHEN {word} IN ({', '.join(map(quoted, members))}) THEN {quoted(tag)}" for tag, members in LEXICON.items()]
    cases += [f"WHEN regexp_matches({word}, {quoted(p)}) THEN {quoted(t)}" for p, t in RULES]
    return f"CASE {' '.join(cases)} ELSE 'NN' END"


def tagged(text: Column, separator: str = SEPARATOR) -> Column:
    """``word_TAG`` of each token of tokenised text, joined by spaces."""
    found = F.filter(F.split(text, " "), lambda w: w != "")
    return F.array_join(F.transform(found, lambda w: F.concat(w, F.lit(separator), tag_of(w))), " ")


def tagged_arrow(texts: pa.Array, separator: str = SEPARATOR) -> pa.Array:
    """``tagged`` of Arrow texts: each distinct word is tagged once."""
    cut = pc.split_pattern(texts, " ")
    words = cut.flatten().dictionary_encode()
    own, names = words.dictionary, list(dict.fromkeys([*LEXICON, *(t for _, t in RULES), "NN"]))
    known = {}
    for tag, members in LEXICON.items():
        for w in members:
            known.setdefault(w, names.index(tag))
    places = pc.index_in(own, pa.array(list(known), pa.string())).fill_null(-1).to_numpy()
    tags = np.append(np.array(list(known.values())), -1)[places]
    for pattern, tag in RULES:
        found = pc.match_substring_regex(own, pattern).to_numpy(zero_copy_only=False)
        tags[found & (tags < 0)] = names.index(tag)
    tags[tags < 0] = names.index("NN")
    values = pc.binary_join_element_wise(own, pa.array(names, pa.string()).take(pa.array(tags)), separator)
    return mapped(cut, words.indices.to_numpy(), pc.if_else(pc.equal(own, ""), "", values))


def tagger(spark: SparkSession, res: TokenResources | None = None):
    """A column function: struct (tokens, tagged) of a text."""
    ship(spark)
    res = res or TokenResources()

    @F.arrow_udf("tokens string, tagged string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = Tokenizer(res)
        for texts in batches:
            tokens = tokenizer.lines(texts)
            yield pa.StructArray.from_arrays([tokens, tagged_arrow(tokens)], ["tokens", "tagged"])

    return run


def pairs(text: Column) -> Column:
    """Array of (word, tag)."""
    found = F.filter(F.split(text, " "), lambda w: w != "")
    return F.transform(found, lambda w: F.struct(w.alias("word"), tag_of(w).alias("tag")))


def tag_with(df: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], text: str = "text", separator: str = SEPARATOR) -> DataFrame:
    """``df`` with ``tagged``, by a user's model. ``load`` runs once per task and returns words -> tags."""
    ship(df.sparkSession)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tag = load()
        for texts in batches:
            out = []
            for t in texts.to_pylist():
                found = (t or "").split()
                out.append(None if t is None else " ".join(f"{w}{separator}{p}" for w, p in zip(found, tag(found), strict=True)))
            yield pa.array(out, pa.string())

    return df.withColumn("tagged", run(F.col(text)))

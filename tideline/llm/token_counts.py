"""Token counts with a whole-token shortcut.

Before any text is read, the merges are run over the vocabulary itself: a
string that ends up as a single token is proven to be one whenever it is a
word of its own.  In the texts such words count 1 by a look-up; only the rest
are merged, each distinct word once in the bounded memory of a Python worker.

Follows the normalisation of the vocabulary file: special strings are cut out
of the raw text (1 token each), then NFC, lower case, and the file's own word
pattern.  One narrow pass, nothing is shuffled; the vocabulary, of fixed size,
is broadcast.

Defined results: null counts as empty; empty texts have 0 tokens; repeated
rows get equal results; input columns named like a result give way to it.
"""

from __future__ import annotations

import json
import pickle
import unicodedata
import uuid
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, types as T

from tideline.llm.classes import Words
from tideline.llm.frames import bounded_batches, without
from tideline.llm.merges import Memory, kept, merge
from tideline.plans.tables import table

#: Tokens a text may have.
LIMIT = 2048


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where Latin-1 prints it, else the next character from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def word_pattern(data: dict) -> Words:
    """The pattern of the vocabulary file, with the character tables of its library."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")

    def members(pattern: str, text: str) -> list[str]:
        cut = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        return [piece for piece, _ in cut.pre_tokenize_str(text)]

    return Words.fitted(split["pattern"]["Regex"], members, normalizers.Lowercase().normalize_str)


class WordCounter:
    """Counts the tokens of texts; built from the parsed vocabulary file."""

    def __init__(self, data: dict, words: Words):
        model = data["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab = model["vocab"].keys()
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.letters = byte_letters()
        special = [t["content"] for t in data["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = words.compiled()

    def pieces(self, letters: str) -> list[str]:
        if not letters:
            return []
        return merge([*letters[:-1], letters[-1] + self.end], lambda a, b: self.ranks.get((a, b)))

    def prove(self) -> set[str]:
        """Words, in byte letters, that are one token when they stand alone."""
        ends = (t[: -len(self.end)] for t in self.vocab if t.endswith(self.end))
        return {w for w in ends if w and len(self.pieces(w)) == 1}

    def memory(self, proven: set[str]) -> Memory:
        """Token counts by word; the proven words are there from the start."""
        back = {c: b for b, c in enumerate(self.letters)}
        fixed = {}
        for w in proven:
            try:
                fixed[bytes(back[c] for c in w).decode()] = 1
            except UnicodeDecodeError:
                pass  # part of a character, never a word of a text

        def count(word: str) -> int:
            return sum(p in self.vocab for p in self.pieces("".join([self.letters[b] for b in word.encode()])))

        return Memory(count, fixed)

    def count(self, text: str, memory: Memory) -> int:
        total = 0
        if self.special:
            parts = self.special.split(text)
            total = len(parts) - 1
        else:
            parts = [text]
        for part in parts:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            total += sum(map(memory.__getitem__, self.words.findall(part, lower=True)))
        return total


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT, gone: Sequence[str] = ()) -> DataFrame:
    """The documents, without the columns ``gone``, with ``n_bytes``, ``n_tokens`` and ``over_limit``; ``vocabulary`` is a file the driver reads."""
    spark = bounded_batches(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        data = json.load(file)
    words = word_pattern(data)
    packed = spark.sparkContext.broadcast(pickle.dumps((data, words, WordCounter(data, words).prove())))
    key = uuid.uuid4().hex
    fields = without(docs.schema, ["n_bytes", "n_tokens", "over_limit", *gone]).fields
    schema = T.StructType([
        *fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ])

    def build():
        data, words, proven = pickle.loads(packed.value)
        counter = WordCounter(data, words)
        return counter, counter.memory(proven)

    def run(batches):
        counter, memory = kept(key, build)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            counts = pa.array([counter.count(t, memory) for t in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], pc.binary_length(texts.cast(pa.large_binary())).cast(pa.int64()),
                 counts, pc.greater(counts, limit)],
                schema.names,
            )

    return docs.mapInArrow(run, schema)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), gone=["text"])
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {"op6_token_counts": op6_token_counts}
ORACLE: dict[str, str] = {}

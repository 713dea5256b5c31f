"""End-to-end jobs put together from the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.functions import text as tx
from inkstrata.functions import tokens as tk
from inkstrata.operators import answering, chunking, evaluation, examples, search, sinks
from inkstrata.operators import vocabulary as vb
from inkstrata.operators.cleaning import process_examples
from inkstrata.session import cut_lineage, materialize
from inkstrata.sources.specs import read_datasets


def public_corpus(
    spark: SparkSession, specs: Sequence[str], root: str, layout: str, order_by: list[str],
    shard_size: int = sinks.SHARD_SIZE, skip_failed: bool = False,
) -> DataFrame:
    """Datasets read, cleaned and assigned to shards."""
    raw, _ = read_datasets(spark, specs, root, layout, skip_failed)
    # cleaned once; numbering reads the keys of the written records
    records = materialize(process_examples(raw, keep=["dataset", "split", *order_by]), "records")
    return sinks.assign_shards(records, order_by, shard_size)


def answer_questions(
    questions: DataFrame,
    documents: DataFrame,
    chunker: chunking.Chunker,
    embed: Callable[[Column], Column],
    dim: int,
    doc_id: str = "doc_id",
    top_k: int | None = None,
    metric: str = "cosine",
    digits: int | None = None,
    generator: Callable[[str], str] | None = None,
) -> DataFrame:
    """Answers with citations for a table of questions over a table of documents.

    ``documents`` has the key, ``text``, ``file_path`` and ``commit``;
    ``questions`` has ``query_id, question``. The search reads nothing of the
    chunks but their vectors. The few hits are kept, and only the documents they
    name are chunked again for their text.
    """
    position = [doc_id, "chunk_index"]
    k = answering.effective_top_k(top_k)

    def chunks_of(docs: DataFrame) -> DataFrame:
        return chunking.drop_blank(chunking.chunk(docs, chunker))

    vectors = chunks_of(documents.select(doc_id, "text")).select(*position, embed(F.col("content")).alias("embedding"))
    asked = questions.select("query_id", embed(F.col("question")).alias("embedding"))
    hits = cut_lineage(search.top_k(asked, vectors, k, dim, position=position, metric=metric, digits=digits))

    found = search.attach_hits(hits, chunks_of(search.named_rows(documents, hits, doc_id)), position)
    return answering.assemble_answers(questions, found, generator=generator)


def answer_from_index(
    questions: DataFrame,
    index: DataFrame,
    embed: Callable[[Column], Column],
    dim: int,
    position: Sequence[str] = ("doc_id", "chunk_index"),
    top_k: int | None = None,
    metric: str = "cosine",
    digits: int | None = None,
    generator: Callable[[str], str] | None = None,
) -> DataFrame:
    """Answers with citations from a stored index.

    The index has the position, ``content, file_path, commit, embedding``. The
    search reads its vectors; the text is read for the hits.
    """
    asked = questions.select("query_id", embed(F.col("question")).alias("embedding"))
    hits = cut_lineage(
        search.top_k(asked, index, answering.effective_top_k(top_k), dim, position=position, metric=metric, digits=digits)
    )
    found = search.attach_hits(hits, index.drop("embedding"), position)
    return answering.assemble_answers(questions, found, generator=generator)


def training_examples(
    texts: DataFrame, vocabulary: DataFrame, key: str, seq_length: int, batch_size: int,
    pad_id: int = vb.PAD, bos_id: int = vb.BOS,
) -> DataFrame:
    """Texts to fixed-length examples with masks, batch places and shifted targets."""
    pad, bos = tk.resolve_special_ids(pad_id, bos_id)
    rows = texts.where(F.col("text") != "")
    # the texts are read once; numbering reads the narrow table
    encoded = materialize(vb.encode_words(rows, vocabulary, key, limit=seq_length - 1), "encoded")
    placed = examples.assign_batches(encoded.select(key), batch_size, [key])
    # joined while the rows are narrow; the examples are made in place
    return examples.with_targets(examples.fixed_examples(encoded.join(placed, key), seq_length, pad, bos), pad)


def instruction_examples(
    turns: DataFrame, vocabulary: DataFrame, batch_size: int, max_length: int = 1024
) -> DataFrame:
    """Instruction pairs to padded batches."""
    keys = ["conv_id", "turn"]
    encoded = materialize(vb.encode_words(examples.instruction_pairs(turns), vocabulary, keys, limit=max_length), "encoded")
    placed = examples.assign_batches(encoded.select(*keys), batch_size, keys)
    padded = examples.dynamic_padding(encoded.join(placed, ["conv_id", "turn"]), max_length)
    return examples.with_targets(padded, 0, shifted=False)


def qa_report(records: DataFrame, generator: Callable[[str], str] | None = None, output: str = "output") -> DataFrame:
    """Exact match of the answers behind the prompts.

    Records have ``question, context, answers`` and, without a generator, the
    model output in ``output``.
    """
    prompt = tx.qa_prompt(F.col("question"), F.col("context"))
    prompted = records.withColumn("prompt", prompt)
    if generator is not None:
        prompted = prompted.withColumn(output, answering.generate_with(generator, F.col("prompt")))
    scored = prompted.select(
        tx.strip(tx.completion_after(F.col(output), F.col("prompt"))).alias("prediction"),
        F.coalesce("answers", F.array().cast("array<string>")).alias("references"),
    )
    return evaluation.exact_match(scored)


# Pairs of words that every task may hold.
SMALL_PAIRS = 1_000_000


def perplexity_report(
    texts: DataFrame, key: str, order_by: Sequence[str], max_samples: int | None = 128, max_length: int | None = 1024
) -> DataFrame:
    """Perplexity of the leading texts under a bigram model of all texts."""
    model = evaluation.learn_bigrams(texts)
    sample = texts if max_samples is None else evaluation.take_first(texts, order_by, max_samples)
    few = max_samples is not None and max_length is not None and max_samples * max_length <= SMALL_PAIRS
    return evaluation.perplexity(evaluation.bigram_loss(sample, model, key, max_length=max_length, small=few))

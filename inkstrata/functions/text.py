"""String expressions: Unicode strip, code fences, whitespace, templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkstrata.functions.binding import let

# The code points a Unicode-aware strip removes.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029"
    r"\u202f\u205f\u3000]"
)

# The fence, blank-run and word patterns.
FENCE_BODY = r"(?s)```(?:[a-zA-Z0-9_+-]+\n)?(.*?)```"
FENCE_TRIMMED = r"(?s)```(?:[a-zA-Z0-9_+-]+\n)?\n*+((?:.*?[^\n])??)\n*+```"
CODE_TAGS = "\n<code>\n$1\n</code>\n"
BLANK_RUN = r"[ \t]{2,}"
NEWLINE_RUN = r"\n{3,}"
WORD_BREAK = r"[\t-\r ]+|(?<=[0-9])(?![\t-\r ])|(?<![\t-\r ])(?=[0-9])"

# Prompt and record templates.
ASSISTANT_RULE = "You are a security-cleared assistant that must cite your sources.\n"
CONTEXT_HEAD = "Context:\n"
QUESTION_HEAD = "\n\nUser question: "
QA_QUESTION, QA_CONTEXT, QA_ANSWER = "Question: ", "\nContext: ", "\nAnswer:"
RECORD_HEAD, RECORD_MIDDLE, RECORD_END = "<s>Instruction:\n", "\n\nResponse:\n", "</s>"
SCORE_FORMAT = " (score=%.3f)"
NO_CONTEXT = "No context available."
NO_CITATIONS = "No citations available."
ANSWER_MARK = "Assistant:"
UNKNOWN_PATH = "unknown"
DEFAULT_COMMIT = "HEAD"


def strip(c: Column) -> Column:
    """Remove white space at both ends, all Unicode kinds of it."""
    return F.trim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    return F.length(strip(c)) == 0


# The patterns below are tried only on texts that hold what they look for: most
# texts do not, and a plain byte search is far cheaper.


def tag_code_blocks(c: Column) -> Column:
    """Fenced blocks become ``<code>`` sections without outer newlines."""
    return F.when(F.contains(c, F.lit("```")), F.regexp_replace(c, FENCE_TRIMMED, CODE_TAGS)).otherwise(c)


def code_blocks(c: Column) -> Column:
    """Bodies of all fenced blocks in order, stripped."""
    bodies = F.transform(F.regexp_extract_all(c, F.lit(FENCE_BODY), F.lit(1)), strip)
    return F.when(F.contains(c, F.lit("```")), bodies).otherwise(F.array().cast("array<string>"))


def newlines_only(c: Column) -> Column:
    return F.replace(c, F.lit("\r"), F.lit("\n"))


def squeeze_blanks(c: Column) -> Column:
    runs = F.contains(c, F.lit("  ")) | F.contains(c, F.lit("\t"))
    return F.when(runs, F.regexp_replace(c, BLANK_RUN, " ")).otherwise(c)


def squeeze_newlines(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("\n\n\n")), F.regexp_replace(c, NEWLINE_RUN, "\n\n")).otherwise(c)


def normalize_whitespace(c: Column) -> Column:
    return let(newlines_only(c), lambda t: let(squeeze_blanks(t), lambda s: strip(squeeze_newlines(s))))


def universal_newlines(c: Column) -> Column:
    """Line ends as a text-mode read delivers them."""
    return F.regexp_replace(c, "\r\n?", "\n")


def words(c: Column) -> Column:
    """White-space separated words; every digit is a word of its own."""
    # cutting at the breaks is several times faster than collecting the matches
    return F.array_remove(F.split(c, WORD_BREAK), "")


def characters(c: Column) -> Column:
    return F.split(c, "")


def normalize_answer(c: Column) -> Column:
    return F.lower(strip(c))


def shard_dir_name(name: Column, config: Column) -> Column:
    """Directory name of a dataset: no slashes, configuration appended."""
    flat = F.replace(name, F.lit("/"), F.lit("_"))
    return F.when(
        F.coalesce(config, F.lit("")) != "", F.concat(flat, F.lit("__"), config)
    ).otherwise(flat)


def file_suffix(path: Column) -> Column:
    """Suffix of the last path part with its dot, case kept; '' if there is none."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def citation(path: Column, commit: Column) -> Column:
    return F.concat(
        F.coalesce(path, F.lit(UNKNOWN_PATH)), F.lit("@"), F.coalesce(commit, F.lit(DEFAULT_COMMIT))
    )


def context_block(rank: Column, path: Column, commit: Column, text: Column) -> Column:
    return F.concat(
        F.lit("["), rank.cast("string"), F.lit("] ("), citation(path, commit), F.lit(")\n"), strip(text)
    )


def retrieval_prompt(question: Column, blocks: Column) -> Column:
    """Prompt from the question and its context blocks in rank order."""
    context = F.coalesce(F.nullif(F.array_join(blocks, "\n\n"), F.lit("")), F.lit(NO_CONTEXT))
    return F.concat(
        F.lit(ASSISTANT_RULE + CONTEXT_HEAD),
        context,
        F.lit(QUESTION_HEAD),
        question,
        F.lit("\n" + ANSWER_MARK),
    )


def citation_line(rank: Column, path: Column, commit: Column, score: Column) -> Column:
    return F.concat(
        F.lit("["), rank.cast("string"), F.lit("] "), citation(path, commit),
        F.format_string(SCORE_FORMAT, score),
    )


def text_after_marker(prompt: Column) -> Column:
    """What follows the last answer marker, stripped."""
    return strip(F.substring_index(prompt, ANSWER_MARK, -1))


def qa_prompt(question: Column, context: Column) -> Column:
    return F.concat(F.lit(QA_QUESTION), question, F.lit(QA_CONTEXT), context, F.lit(QA_ANSWER))


def completion_after(output: Column, prompt: Column) -> Column:
    """Generated text behind the echoed prompt, not stripped."""
    return F.substring(output, F.length(prompt) + 1, F.length(output))


def instruction_record(prompt: Column, response: Column) -> Column:
    return F.concat(F.lit(RECORD_HEAD), prompt, F.lit(RECORD_MIDDLE), response, F.lit(RECORD_END))


def candidate_program(code: Column, completion: Column) -> Column:
    return F.concat(F.coalesce(code, F.lit("")), F.lit("\n"), completion)


def test_list(c: Column) -> Column:
    """Tests of a record: a JSON list, else the string itself as the only test."""
    parsed = F.from_json(c, "array<string>")
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.coalesce(parsed, F.array(c))
    )

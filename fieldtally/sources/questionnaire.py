"""Questions and answer-option labels from a questionnaire description.

Three layouts are read:

* ``document``: the survey software's nested questionnaire document, one per file.
  Sections and rosters hold ``Children``, questions hold ``Answers``.
* ``documents``: the same, one document per line.
* ``lines``: one question per line in a flat shape,
  ``{"variable": "...", "type": "...", "answers": [{"value": 1, "label": "..."}]}``.

A document stays one row until all its nodes are known: each level is an array made
from the ``Children`` of the level above, so the file is scanned once and nothing is
shuffled. How many levels there are is found first, by going down until no document
has a further one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUESTION_SCHEMA = (
    "variable string, type string, answers array<struct<value: int, label: string>>"
)

# Keys of the survey software's questionnaire document.
CHILDREN = "$.Children"
TITLE = "$.Title"
IS_ROSTER = "$.IsRoster"
VARIABLE_NAME = "$.VariableName"
EXPORT_NAME = "$.StataExportCaption"
QUESTION_TEXT = "$.QuestionText"
KIND = "$['$type']"
ANSWERS = "$.Answers"
ANSWER_VALUE = "$.AnswerValue"
ANSWER_TEXT = "$.AnswerText"

#: Levels that one search job looks at; deeper documents take another job.
LEVELS_PER_SEARCH = 8

LAYOUTS = ("lines", "document", "documents")


def _explode_answers(questions: DataFrame) -> DataFrame:
    return questions.select(
        F.col("variable").alias("var"), F.inline("answers")
    ).select("var", "value", "label")


def _text(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "string")


def _name(node: Column) -> Column:
    """Variable name of a node; empty names count as none."""
    return F.coalesce(
        *(F.nullif(_text(node, key), F.lit("")) for key in (VARIABLE_NAME, EXPORT_NAME))
    )


def _children(node: Column) -> Column:
    none = F.array().cast("array<variant>")
    return F.coalesce(F.try_variant_get(node, CHILDREN, "array<variant>"), none)


def _appended(items: Column, value: Column, keep: Column) -> Column:
    return F.when(keep, F.concat(items, F.array(value))).otherwise(items)


def _next_level(level: Column) -> Column:
    """All children of a level, each with the sections and rosters around it."""

    def below(entry: Column) -> Column:
        node, name = entry["node"], _name(entry["node"])
        roster = F.coalesce(F.try_variant_get(node, IS_ROSTER, "boolean"), F.lit(False))
        title = F.coalesce(_text(node, TITLE), F.lit(""))
        sections = _appended(entry["sections"], title, F.lit(True))
        rosters = _appended(entry["rosters"], F.coalesce(name, title), roster)
        return F.transform(
            _children(node),
            lambda child: F.struct(
                sections.alias("sections"), rosters.alias("rosters"), child.alias("node")
            ),
        )

    return F.flatten(F.transform(level, below))


def _levels(documents: DataFrame, first: Column, count: int) -> DataFrame:
    """``documents`` with the arrays ``level_0`` to ``level_{count}``."""
    found = documents.withColumn("level_0", first)
    for k in range(count):
        found = found.withColumn(f"level_{k + 1}", _next_level(F.col(f"level_{k}")))
    return found


def _depth(documents: DataFrame, first: Column) -> int:
    """Levels below the documents themselves, in the deepest document."""
    most = LEVELS_PER_SEARCH
    while True:
        sizes = [
            F.max(F.when(F.size(f"level_{k}") > 0, k)).alias(f"n{k}") for k in range(most + 1)
        ]
        row = _levels(documents, first, most).agg(F.greatest(*sizes, F.lit(0))).first()
        if row[0] < most:
            return row[0]
        most *= 2


def questions_from_documents(texts: DataFrame, column: str = "value") -> DataFrame:
    """All questions of nested documents, one document per row of ``column``.

    Rows are (document, variable, type, text, sections, rosters, answers):
    ``document`` is the title, ``sections`` and ``rosters`` are the titles and names
    around the question, from the outside in. Rows that are not a document are left
    out. One or two small jobs find the depth.
    """
    # exports may start with a byte order mark
    text = F.regexp_replace(F.col(column), "^\ufeff", "")
    documents = texts.select(F.try_parse_json(text).alias("whole")).where(
        F.col("whole").isNotNull()
    )
    none = F.array().cast("array<string>")
    first = F.transform(
        _children(F.col("whole")),
        lambda child: F.struct(none.alias("sections"), none.alias("rosters"), child.alias("node")),
    )
    depth = _depth(documents, first)
    levels = [F.col(f"level_{k}") for k in range(depth + 1)]
    entries = _levels(documents, first, depth).select(
        _text(F.col("whole"), TITLE).alias("document"), F.inline(F.concat(*levels))
    )
    node = F.col("node")
    answers = F.transform(
        F.coalesce(
            F.try_variant_get(node, ANSWERS, "array<variant>"), F.array().cast("array<variant>")
        ),
        lambda answer: F.struct(
            F.try_variant_get(answer, ANSWER_VALUE, "double").cast("int").alias("value"),
            _text(answer, ANSWER_TEXT).alias("label"),
        ),
    )
    is_question = F.try_variant_get(node, ANSWERS, "array<variant>").isNotNull() | _text(
        node, QUESTION_TEXT
    ).isNotNull()
    return entries.where(is_question & _name(node).isNotNull()).select(
        "document",
        _name(node).alias("variable"),
        _text(node, KIND).alias("type"),
        _text(node, QUESTION_TEXT).alias("text"),
        "sections",
        "rosters",
        answers.alias("answers"),
    )


def _layout_of(spark: SparkSession, path: str) -> str:
    """A first line that is a question of its own means one question per line."""
    line = spark.read.text(path).limit(1)
    own = F.try_variant_get(F.try_parse_json("value"), "$.variable", "string").isNotNull()
    return "lines" if line.where(own).take(1) else "document"


def questions(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    """Questions in any layout; without ``layout`` the first line decides between
    one question per line and one document per file."""
    layout = layout or _layout_of(spark, path)
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}, expected one of {LAYOUTS}")
    if layout == "lines":
        return spark.read.schema(QUESTION_SCHEMA).json(path)
    return questions_from_documents(spark.read.text(path, wholetext=layout == "document"))


def questionnaire_labels(
    spark: SparkSession, path: str, layout: str | None = None
) -> DataFrame:
    """(var, value, label) rows of all questions in the file."""
    return _explode_answers(questions(spark, path, layout))


def labels_from_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The same from a DataFrame that holds one JSON question per row."""
    parsed = lines.select(F.from_json(column, QUESTION_SCHEMA).alias("q"))
    return _explode_answers(parsed.select("q.*"))


def option_labels(
    spark: SparkSession, path: str, variable: str, layout: str | None = None
) -> list[tuple[int, str]]:
    """(code, label) pairs of one question, for table headings.

    This starts small jobs; the result is the option list of one question. A
    code that occurs twice raises an error.
    """
    rows = (
        questionnaire_labels(spark, path, layout)
        .filter(F.col("var") == variable)
        .select("value", "label")
        .collect()
    )
    codes = [r["value"] for r in rows]
    repeated = sorted({c for c in codes if codes.count(c) > 1}, key=str)
    if repeated:
        raise ValueError(f"question {variable!r} repeats the codes {repeated}")
    return [(r["value"], r["label"]) for r in rows]

"""Prompt text and chat messages as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.functions.text import is_blank, or_empty

MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
CHAT = T.ArrayType(MESSAGE)

# Defaults only: pass the wording that suits the model in use.
REWRITE_TEMPLATE = """Du får en norsk tekst som kan være stiv eller oversatt ord for ord. Gi den tilbake \
på ledig norsk, med samme innhold og like mange opplysninger.

Slik ser det ut:
Original: Været vil i morgen komme til å være preget av regn.
Bedre: I morgen blir det regn.

Engelsk utgave, bare for meningen: {reference}

Skriv bare den nye teksten, uten forklaring.

{text}"""

SYSTEM_MESSAGE = "Du er en kunnskapsrik hjelper. Svar på norsk bokmål."


def rewrite_prompt(text: Column, reference: Column, template: str = REWRITE_TEMPLATE) -> Column:
    """Fills ``{text}`` and ``{reference}`` of a template.

    The template is cut at its placeholders and joined with the columns, so
    braces or placeholder names inside the data stay as they are.
    """
    values = {"{text}": or_empty(text), "{reference}": or_empty(reference)}
    pieces = [p for p in re.split(r"(\{text\}|\{reference\})", template) if p]
    return F.concat(*[values[p] if p in values else F.lit(p) for p in pieces])


def user_content(instruction: Column, context: Column) -> Column:
    """The instruction, then a blank line and the input when there is one."""
    return F.concat(
        or_empty(instruction),
        F.when(is_blank(context), F.lit("")).otherwise(F.concat(F.lit("\n\n"), context)),
    )


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_prompt(instruction: Column, context: Column, system: str | None = None) -> Column:
    """A chat message list; ``system`` puts a system message in front."""
    messages = [_message("user", user_content(instruction, context))]
    if system is not None:
        messages.insert(0, _message("system", F.lit(system)))
    return F.array(*messages).cast(CHAT)


def first_content(messages: Column) -> Column:
    """Content of the first message, NULL for a NULL or empty list."""
    return F.get(messages, F.lit(0)).getField("content")

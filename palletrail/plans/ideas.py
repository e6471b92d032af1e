"""Idea intake: texts to translate, notifications to send, point balances to announce."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from palletrail.config import FIRST_TICKET, TICKET_PREFIX
from palletrail.functions.text import leading_number, name_from_mail, ticket_format, ticket_number


def translation_pending(intake: DataFrame) -> DataFrame:
    """Ideas with a source text and no translation yet."""
    blank, text = F.coalesce("target_text", F.lit("")) == "", F.coalesce("source_text", F.lit(""))
    return intake.where(blank & (text != "")).select("ticket", "source_text")


def notification_outbox(intake: DataFrame, sent: DataFrame | None = None, first: int = FIRST_TICKET,
                        prefix: str = TICKET_PREFIX) -> DataFrame:
    """Tickets still to announce: numbered, from the first counted one on, status empty.

    ``sent`` holds the ticket numbers announced by earlier runs; they are left out.
    """
    number = ticket_number(F.col("ticket"))
    rows = intake.where((number >= first) & (F.coalesce("status", F.lit("")) == "")).select(
        number.alias("number"), ticket_format(number, prefix).alias("ticket_id"), "source_text")
    return rows if sent is None else rows.join(sent.select("number").distinct(), "number", "left_anti")


def reward_digest(scoreboard: DataFrame) -> DataFrame:
    """Contacts with points to spend, and the first name to greet them by."""
    points = leading_number(F.col("points"))
    rows = scoreboard.where((F.trim("mail") != "") & (points > 0))
    return rows.select("mail", name_from_mail(F.col("mail")).alias("first_name"), points.alias("points"))

"""Rule tables turned into column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from palletrail.config import CATEGORIES, GRADES, SOURCES, UNKNOWN, ChannelRule


def map_codes(code: Column, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Label of a code; codes outside the table, and NULL, give the default."""
    chain = F
    for value, label in labels.items():
        chain = chain.when(code == value, F.lit(label))
    return chain.otherwise(F.lit(default))


def grade_plain(code: Column, default: str | None = UNKNOWN) -> Column:
    return map_codes(code, GRADES, default)


def _grade_unless_unsortable(code: Column, unsortable: Column) -> Column:
    """Top grade drops one step for goods the sorter cannot take."""
    top, next_grade = list(GRADES.values())[:2]
    return F.when((code == "1") & unsortable, F.lit(next_grade)).otherwise(grade_plain(code))


def grade_single(code: Column, sortable: Column) -> Column:
    """Grade of normal goods; the sortable flag is compared without case."""
    return _grade_unless_unsortable(code, F.lower(sortable) == "false")


def grade_dual(in_code: Column, out_code: Column, in_sortable: Column, out_sortable: Column) -> Column:
    """Grade of dummy goods: arrival leg first; the sortable flag is compared as written."""
    sortable = F.coalesce(in_sortable, out_sortable)
    return _grade_unless_unsortable(F.coalesce(in_code, out_code), sortable == "false")


def category_map(code: Column, default: str | None = UNKNOWN) -> Column:
    return map_codes(code, CATEGORIES, default)


def source_channel_map(code: Column, default: str = UNKNOWN, labels: Mapping[str, str] = SOURCES) -> Column:
    return map_codes(code, labels, default)


def distribution_channel(
    rules: Sequence[ChannelRule],
    channel: Column,
    source: Column,
    target: Mapping[str, Column],
    grade: Column | None = None,
) -> Column:
    """First matching rule wins.

    ``target`` maps each LIKE pattern the rules use to the column that answers it, so
    the rules work on a carrier as well as on flags computed beforehand.
    """
    tested = {"channel": channel, "source": source, "grade": grade}
    chain = F
    for rule in rules:
        if rule.test == "target":
            hit = target[rule.values[0]]
        else:
            hit = tested[rule.test].isin(*rule.values)
        chain = chain.when(hit, F.lit(rule.label))
    return chain.otherwise(F.lit(UNKNOWN))


def like_target(carrier: Column, patterns: Sequence[str]) -> dict[str, Column]:
    return {pattern: carrier.like(pattern) for pattern in patterns}


def clarification_flag(origin: Column) -> Column:
    return F.when(origin == 2, F.lit("Yes")).otherwise(F.lit("No"))


def ean_two_step(good_type: Column, article: Column, last_ean: Column) -> Column:
    """Scanned EAN if there is one, else the article number.

    A dummy article number counts only if it is an internal one (``2%``).
    """
    own = F.when((good_type == "DUMMY") & ~article.like("2%"), last_ean).otherwise(article)
    return F.coalesce(last_ean, own)


def ean_three_step(source_article: Column, last_ean: Column, target_article: Column) -> Column:
    """Internal source article, else scanned EAN, else internal target article, else source."""
    return (
        F.when(source_article.like("2%"), source_article)
        .when(last_ean.isNotNull(), last_ean)
        .when(target_article.like("2%"), target_article)
        .otherwise(source_article)
    )


def by_origin(good_type: Column, of_out: Column, of_in: Column) -> Column:
    """Field of leg 1 for normal goods, of leg 2 for dummy goods."""
    return F.when(good_type == "NORMAL", of_out).when(good_type == "DUMMY", of_in)

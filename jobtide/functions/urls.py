"""What a board URL says: provider, company, link style."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.functions.keys import skipping_concat


def _piece(text: Column, separator: str, position: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(position))


def provider_of(url: Column) -> Column:
    """Second dot-separated piece of the host."""
    return _piece(url, ".", 2)


def normalise_url(url: Column) -> Column:
    """The URL without its one trailing slash."""
    return F.regexp_replace(url, "/$", "")


def _is_embed(source: Column) -> Column:
    return _piece(source, "/", 4) == "embed"


def is_full_link(source: Column) -> Column:
    """Do postings of this board carry absolute links (embedded boards and the newer host)?"""
    return _is_embed(source) | (_piece(_piece(source, "/", 3), ".", 1) == "job-boards")


def full_link(source: Column, link: Column) -> Column:
    """Absolute links stay; relative ones keep their 3rd and 4th piece behind the board URL."""
    rebuilt = skipping_concat(
        source, F.lit("/"), _piece(link, "/", 3), F.lit("/"), _piece(link, "/", 4)
    )
    return F.when(is_full_link(source), link).otherwise(rebuilt)


def board_company(source: Column) -> Column:
    """Company of a staged board: behind ``=`` for embeds, else the last path piece without its query."""
    last = _piece(_piece(source, "/", -1), "?", 1)
    return F.when(_is_embed(source), _piece(source, "=", -1)).otherwise(last)


def page_company(source: Column) -> Column:
    """Company of a stored page: behind ``for=`` if there is one, else the last path piece."""
    last = _piece(_piece(source, "/", -1), "?", 1)
    return F.when(source.contains("for="), _piece(source, "for=", -1)).otherwise(last)


def token_company(url: Column) -> Column:
    """Company of a JSON board: the last path piece with ``%20`` read as a space."""
    return F.replace(_piece(url, "/", -1), F.lit("%20"), F.lit(" "))

"""Looking at what operators give: decorators that log columns, or rows on demand, and a formatter with colours."""

from __future__ import annotations

import functools
import logging
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

log = logging.getLogger("tidemark.debug")

# Terminal colours of levels, and the code that ends one.
COLOURS = {logging.INFO: "\033[34m", logging.WARNING: "\033[33m", logging.ERROR: "\033[31m"}
_PLAIN = "\033[0m"


class ColourFormatter(logging.Formatter):
    """A whole line in the colour of its level; levels without one stay plain."""

    def format(self, record: logging.LogRecord) -> str:
        line = super().format(record)
        return f"{COLOURS[record.levelno]}{line}{_PLAIN}" if record.levelno in COLOURS else line


def colour_logger(name: str = "tidemark", level: int = logging.INFO, stream: Any = None) -> logging.Logger:
    """The named logger with one coloured handler, however often this is called."""
    logger = logging.getLogger(name)
    logger.setLevel(level)
    for handler in [h for h in logger.handlers if isinstance(h.formatter, ColourFormatter)]:
        logger.removeHandler(handler)
    handler = logging.StreamHandler(stream)
    handler.setFormatter(ColourFormatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
    logger.addHandler(handler)
    return logger


def logs_columns(function: Callable[..., Any]) -> Callable[..., Any]:
    """Logs the columns of a resulting DataFrame; no job runs."""

    @functools.wraps(function)
    def wrapped(*args: Any, **kwargs: Any) -> Any:
        result = function(*args, **kwargs)
        if isinstance(result, DataFrame):
            log.info("%s gives columns %s", function.__name__, result.columns)
        return result

    return wrapped


def logs_shape(count: bool = False) -> Callable[[Callable[..., Any]], Callable[..., Any]]:
    """Logs the number of columns of a resulting DataFrame and, only if asked for, of its rows, which runs a job."""

    def decorate(function: Callable[..., Any]) -> Callable[..., Any]:
        @functools.wraps(function)
        def wrapped(*args: Any, **kwargs: Any) -> Any:
            result = function(*args, **kwargs)
            if isinstance(result, DataFrame):
                log.info("%s gives %s rows, %d columns", function.__name__, result.count() if count else "uncounted", len(result.columns))
            return result

        return wrapped

    return decorate

"""Preparing and scoring text-to-text fine-tuning corpora as Spark jobs."""

from . import functions, operators, plans, sources
from .functions import *  # noqa: F403
from .operators import *  # noqa: F403
from .plans import *  # noqa: F403
from .sources import *  # noqa: F403

__all__ = [*functions.__all__, *operators.__all__, *plans.__all__, *sources.__all__]

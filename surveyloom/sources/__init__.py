"""Readers and writers for bank documents, question lists, responses and tables."""

from surveyloom.sources.documents import *  # noqa: F401,F403
from surveyloom.sources.ids import *  # noqa: F401,F403
from surveyloom.sources.sinks import *  # noqa: F401,F403
from surveyloom.sources.tables import *  # noqa: F401,F403

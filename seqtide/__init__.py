"""Sequence surveillance on Spark: curate, embed, index, cluster and classify."""

from seqtide.config import DEMO, FULL, Profile
from seqtide.session import local_session

__all__ = ["DEMO", "FULL", "Profile", "local_session"]

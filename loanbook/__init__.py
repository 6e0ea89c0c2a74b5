"""loanbook: consumer-credit portfolio analytics as Spark DataFrame operators."""

from loanbook.snapshot import Snapshot

__all__ = ["Snapshot"]

"""linefold: order-line analytics as Spark DataFrame jobs.

Brings nested order feeds to one line schema, keeps the right version of each
order, unnests and rolls up lines, spreads order totals, adds delivery-fee
lines, attributes employees and stores, matches guarantees and backorders, and
appends valid new lines to a fact table while invalid ones are kept with a
reason and retried on the next pass.

Every operator takes and returns DataFrames (rules return Columns) and is built
from Spark's own functions only.
"""

from linefold.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]

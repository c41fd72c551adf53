"""ledgerlens — revenue analytics as Spark DataFrame jobs.

Average revenue per user, monthly/daily revenue and growth, gateway success and
failure rates, signup-cohort matrices and retention, failure recovery and
revenue leakage, reconciliation and graded data-quality checks. Every operator
is a lazy DataFrame built from Spark SQL built-ins; nothing is collected to the
driver except bounded one-row check results where the caller asks for them.
"""

from ledgerlens.params import Params
from ledgerlens.sources.tables import Tables

__all__ = ["Params", "Tables"]

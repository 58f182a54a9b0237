"""Every operator as a query over the test tables, each with SQL that must agree.

Domain roles are given to the tables by rules (see ``roles``); all rows take part.
"""

from spoorlens.workload import delays, files, locations, texts  # noqa: F401  (register)
from spoorlens.workload.registry import ORACLES, QUERIES  # noqa: F401

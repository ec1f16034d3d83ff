"""orderlens: retail order analytics expressed as Spark DataFrame plans.

The package cleans customer, product, order and order-line tables with exact
accounting, checks their keys and references, and answers fifteen revenue,
ranking, cohort and segmentation questions.  Everything is a lazily evaluated
DataFrame; the few places that run a job while a plan is being built say so.
"""

from orderlens.model import RawTables, Tables
from orderlens.plans.access import list_reports, run_report, save_report

__all__ = ["RawTables", "Tables", "list_reports", "run_report", "save_report"]

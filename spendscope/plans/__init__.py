from spendscope.plans.analysis import Analysis, analyse, load

__all__ = ["Analysis", "analyse", "load"]

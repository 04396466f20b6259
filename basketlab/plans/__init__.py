from basketlab.plans.analysis import Analysis

__all__ = ["Analysis"]

"""Operators: every public function maps DataFrame(s) to a lazy DataFrame.

Modules follow the steps of the analysis: ``clean`` (cleaning, profile),
``ranking`` (distributed order statistics), ``rfm``, ``sequences``,
``features``, ``reports``, ``metrics``, ``campaign``, ``ml_prep`` and
``models``.
"""

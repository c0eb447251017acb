"""Operators for preparing large text corpora (training-data pipelines).

Nothing outside this subpackage imports it. Each module holds one operator with
its general interface; ``queries`` registers one thin query per operator.
Executors import these modules, so the package must be on their Python path.
"""

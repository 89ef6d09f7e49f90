"""Operators for preparing large text corpora (training data), each a Spark job.

``souk.llm.queries`` registers one query per operator. Nothing outside this subpackage
imports it.
"""

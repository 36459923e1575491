"""Operators that prepare text for language-model training.

One module an operator. Nothing else in the library imports this subpackage;
``llm.queries`` registers its queries.
"""

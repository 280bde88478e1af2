"""Training-data operators: de-duplication, filtering, tokenisation, mixing, search.

Nothing else in the library imports this subpackage; ``queries`` registers one
``opN_<name>`` query per operator.
"""

"""Whole jobs and parameterised reports composed from the operators."""

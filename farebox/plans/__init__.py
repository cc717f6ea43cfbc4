"""The relations users ask for, composed from the operators."""

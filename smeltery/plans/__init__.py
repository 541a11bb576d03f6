"""The sales rule set and the jobs composed from the operators."""

"""Dataset builds: the operators put together for the two outcomes."""

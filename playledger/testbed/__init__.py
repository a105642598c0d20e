"""The registered queries: the library run over the supplied test tables, and their SQL."""

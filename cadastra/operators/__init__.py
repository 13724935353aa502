"""DataFrame -> DataFrame operators; every one can be used with ``DataFrame.transform``."""

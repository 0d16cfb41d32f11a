"""Training-data corpus operators (``opN_<name>`` queries) and their pipeline stages."""

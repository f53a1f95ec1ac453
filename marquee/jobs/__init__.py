"""Jobs to submit: curate, analyze, recommend, tune."""

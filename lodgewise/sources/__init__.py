"""Reading feeds, writing tables, describing both."""

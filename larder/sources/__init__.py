"""Reading and writing of the tables the operators work on."""

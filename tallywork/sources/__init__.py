"""Reading and writing tables, and the views the registered queries run on."""

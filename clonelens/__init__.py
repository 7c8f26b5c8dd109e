"""clonelens: immune-repertoire analytics and data-processing operators on PySpark DataFrames."""

"""millrace.functions"""

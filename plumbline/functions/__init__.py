"""plumbline.functions"""

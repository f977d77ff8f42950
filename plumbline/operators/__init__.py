"""plumbline.operators"""
